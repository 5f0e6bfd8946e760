"""Small helpers: building partials, and a plain Python model of the matching rules to compare with."""

from onefold.schema import PARTIAL_SCHEMA, SOURCE_PRIORITY


def partial(source, key, **fields):
    """One partial as a dict; fields that are not named are empty."""
    row = {f.name: None for f in PARTIAL_SCHEMA}
    row.update(genres=[], keywords=[], sources=[source])
    row.update(fields)
    known = source in SOURCE_PRIORITY
    row["source"] = source
    row["source_rank"] = SOURCE_PRIORITY.index(source) if known else len(SOURCE_PRIORITY)
    row["seq"] = (row["source_rank"], f"{key:0>20}")
    return row


def partials_df(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in PARTIAL_SCHEMA) for r in rows], PARTIAL_SCHEMA)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def ratio(a, b):
    return 100 if a == b else round(100 * (2 * lcs(a, b) / (len(a) + len(b))))


def _exact_components(rows):
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for field in ("tmdb_id", "imdb_id"):
            lowest = {}
            for i, r in enumerate(rows):
                if r[field] not in (None, ""):
                    lowest[r[field]] = min(lowest.get(r[field], label[i]), label[i])
            for i, r in enumerate(rows):
                if r[field] not in (None, "") and label[i] != lowest[r[field]]:
                    label[i] = lowest[r[field]]
                    changed = True
    return label


def clusters(rows, threshold=90, tolerance=1):
    """Partition of the positions of `rows` (sorted by input order) as a set of frozensets."""
    rows = sorted(rows, key=lambda r: r["seq"])
    groups = {}
    for i, c in enumerate(_exact_components(rows)):
        groups.setdefault(c, []).append(i)
    reps = {}
    for c, members in groups.items():
        ranked = sorted(members, key=lambda i: (rows[i]["source_rank"], rows[i]["seq"]))
        title = next((rows[i]["title"] for i in ranked if rows[i]["title"]), None)
        year = next((rows[i]["year"] for i in ranked if rows[i]["year"] is not None), None)
        reps[c] = (title, year, any(rows[i]["tmdb_id"] is not None for i in members), min(members))
    target = {}
    for c, (title, year, anchored, _) in reps.items():
        if title is None or year is None or anchored:
            continue
        offers = [
            (-ratio(title.strip().lower(), t.strip().lower()), y, first, other)
            for other, (t, y, has, first) in reps.items()
            if has and t is not None and y is not None and abs(y - year) <= tolerance
        ]
        offers = [o for o in offers if -o[0] >= threshold]
        if offers:
            target[c] = min(offers)[3]
    final = {}
    for c, members in groups.items():
        final.setdefault(target.get(c, c), []).extend(members)
    return rows, {frozenset(m) for m in final.values()}
