import hashlib
import re

from fixtures import documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from onefold.llm import fill_middle as fim
from onefold.llm.queries import QUERIES


def brute(doc_id, text, plain=0, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100 - plain:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = ["", "\n", "a", "a\n", "\n\na", "<P>", "a<\n<S\nb<M", "P>\n<P", "<S>x\ny", "é\r\n😀\n\x0b\x85 \nz", "<\n<\n<", "line\n" * 5000]


def test_against_brute_force_and_back(spark):
    rows = [(i, t) for t in ODD for i in (*range(6), None)] + [(1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(documents(spark).select("doc_id", "text"))
    rows = [tuple(r) for r in docs.collect()]
    for plain, spm in ((0, 50), (30, 80)):
        out = fim.transformed(docs, ["doc_id", "text"], plain_percent=plain, spm_percent=spm)
        got = fim.restored(out, out.columns).collect()
        key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
        want = sorted(((i, t, *brute(i, t, plain, spm)) for i, t in rows), key=key)
        assert sorted(((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=key) == want
        for r in got:
            assert r.restored == (r.text or "")
            assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest()
            assert r.restored_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<PSM>\na😀", max_size=40), st.integers(0, 10**6))
def test_every_text_comes_back(text, doc_id):
    _, form, _, table = fim.rearranged(text.encode(), str(doc_id), fim.SEED, 0, 50)
    assert fim.restored_table(table.joined(), form).joined().decode() == text
    assert table.joined().decode() == brute(doc_id, text)[-1]


def test_clashes_extra_columns_and_empty_tables(spark):
    docs = documents(spark)
    wide = docs.withColumnsRenamed({"row": "_text", "fp": "_key"})
    assert fim.transformed(wide, wide.columns).count() == docs.count()
    wide = docs.withColumnsRenamed({"lang": "form", "source": "output", "score": "restored", "kept": "n"})
    out = fim.transformed(wide, wide.columns)
    assert out.columns == [*wide.columns, "_n", "_form", "prefix_chars", "middle_chars", "_output", "output_sha256"]
    back = fim.restored(out, ["doc_id", "text", "restored"], "_output", "_form")
    assert back.columns[2:] == ["restored", "_restored", "restored_sha256"]
    assert all(r._restored == (r.text or "") for r in back.collect())
    out = fim.transformed(empty(spark), ["doc_id"])
    assert fim.restored(out, out.columns).count() == 0


def test_query_keeps_every_row(spark):
    got = QUERIES["op12_fill_middle"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = sorted((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in docs)
    assert sorted((r.doc_id, r.restored_sha256) for r in got.collect()) == want
