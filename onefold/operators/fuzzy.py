"""Attach clusters without a shared id to the most similar anchored cluster of about the same year.

All pairs within a year would be quadratic. Candidates come from a prefix filter over segments instead. An anchored
title is cut into segments of one length, so short that there are more of them than edits can lie between the title
and a partner. An edit spoils one segment at most, so of any segments, one more than there are edits, some segment
lies whole in the partner: the rarest ones are the title's keys. The other side has all its substrings of that length
as keys, so its rows grow with its length. Where a title leaves no room for segments of two characters, single
characters are keys; only characters that the title loses spoil those, and some always stay. Equal keys meet in an
equality join; length and shift of the segment are conditions of the join, and no pair is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onefold.functions.similarity import PROFILE_WORDS, distance_bound, edits_within, profile, profile_distance, ratio
from onefold.functions.text import title_key
from onefold.session import cut_lineage
from onefold.skew import lookup_join, salted_join

THRESHOLD = 90
YEAR_TOLERANCE = 1


def titled(reps: DataFrame) -> DataFrame:
    """Representatives that can take part in matching, with `norm`, the title as it is compared."""
    return reps.filter(F.col("title").isNotNull() & F.col("year").isNotNull()).withColumn(
        "norm", title_key(F.col("title"))
    )


def anchored_titles(reps: DataFrame) -> DataFrame:
    """Distinct (title, year) of anchored clusters with the first cluster of each."""
    return (
        titled(reps)
        .filter("has_tmdb")
        .groupBy(F.col("norm").alias("anchor_norm"), F.col("year").alias("anchor_year"))
        .agg(F.min(F.struct("first_seq", "cluster_key")).alias("anchor"))
    )


def floating_titles(reps: DataFrame) -> DataFrame:
    """Distinct (title, year) of clusters without a shared id."""
    return titled(reps).filter(~F.col("has_tmdb")).select("norm", "year").distinct()


def candidate_counts(reps: DataFrame, tolerance: int = YEAR_TOLERANCE) -> DataFrame:
    """How many anchored clusters the year block offers to each floating cluster, from year counts."""
    ready = titled(reps)
    per_year = ready.filter("has_tmdb").groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    reach = per_year.withColumn("year", F.explode(_years(F.col("year"), tolerance)))
    totals = reach.groupBy("year").agg(F.sum("n").alias("candidates"))
    floating = ready.filter(~F.col("has_tmdb")).select("cluster_key", "year")
    return lookup_join(floating, totals, ["year"]).select(
        "cluster_key", "year", F.coalesce("candidates", F.lit(0)).alias("candidates")
    )


def similar_titles(
    floating: DataFrame, anchored: DataFrame, threshold: int = THRESHOLD, tolerance: int = YEAR_TOLERANCE
) -> DataFrame:
    """All pairs of a floating and an anchored title with `ratio >= threshold` within the year tolerance.

    Returns `norm, year, anchor_norm, anchor_year, anchor, ratio`.
    """
    if threshold < 1:
        raise ValueError("threshold must be at least 1: every pair has a ratio of 0 or more")
    # A shift t of the segment costs |t| + |lb - la - t| edits, within the bound when |2t - (lb - la)| is.
    bound = distance_bound(F.col("la") + F.col("lb"), threshold)
    pairs = salted_join(
        _index(anchored, floating, threshold, tolerance),
        _probes(floating, threshold),
        ["segment"],
        (F.abs(F.col("la") - F.col("lb")) <= bound)
        & (F.col("nth") <= bound + 1)
        & (profile_distance(_words("a"), _words("b")) <= bound)
        & (2 * (F.col("last_found") - F.col("first_place")) - (F.col("lb") - F.col("la")) >= -bound)
        & (2 * (F.col("first_found") - F.col("last_place")) - (F.col("lb") - F.col("la")) <= bound)
        & edits_within(F.col("norm"), F.col("anchor_norm"), bound),
        rows_per_key=anchored.count(),
    )
    # The lengths come out of the aggregate, so the ratio stays above it: inside the join it would be taken for each key.
    once = pairs.groupBy("norm", "year", "anchor_norm", "anchor_year").agg(
        F.min("anchor").alias("anchor"), F.max(F.col("la") + F.col("lb")).alias("total")
    )
    once = once.withColumn("ratio", ratio(F.col("norm"), F.col("anchor_norm"), F.col("total"))).drop("total")
    return once.filter(F.col("ratio") >= threshold)


def equal_titles(floating: DataFrame, anchored: DataFrame, tolerance: int = YEAR_TOLERANCE) -> DataFrame:
    """The pairs of `similar_titles` whose titles are equal, by a plain equality join."""
    near = floating.withColumn("anchor_year", F.explode(_years(F.col("year"), tolerance)))
    return (
        near.withColumn("anchor_norm", F.col("norm"))
        .join(anchored, ["anchor_norm", "anchor_year"])
        .select("norm", "year", "anchor_norm", "anchor_year", "anchor", F.lit(100).alias("ratio"))
    )


def _order(nearest_year: bool) -> Column:
    """What a pair is judged by; the smallest wins."""
    year = F.abs(F.col("anchor_year") - F.col("year")) if nearest_year else F.col("anchor_year")
    return F.struct(
        (-F.col("ratio")).alias("distance"),
        year.alias("by_year"),
        "anchor_year",
        F.col("anchor.first_seq").alias("first_seq"),
        F.col("anchor.cluster_key").alias("anchor_key"),
        "ratio",
    )


def best_matches(
    reps: DataFrame,
    threshold: int = THRESHOLD,
    tolerance: int = YEAR_TOLERANCE,
    nearest_year: bool = False,
) -> DataFrame:
    """The anchor of each floating cluster that has one: `cluster_key, anchor_key, ratio, anchor_year`.

    Order: higher ratio, then earlier anchor year (or nearer, with `nearest_year`), then the anchor that
    comes first in the input. Equal titles settle most clusters before any segment is cut: no other
    title can reach a rounded ratio of 100 unless the two have 200 characters together.
    """
    best_of = F.min(_order(nearest_year)).alias("best")
    anchored, floating = cut_lineage(anchored_titles(reps)), floating_titles(reps)
    equal = equal_titles(floating, anchored, tolerance).groupBy("norm", "year").agg(best_of)
    first = cut_lineage(floating.join(equal, ["norm", "year"], "left"))
    best = first.filter(F.col("best").isNotNull())
    still_open = first.filter(F.col("best").isNull() | (F.length("norm") >= 100)).select("norm", "year")
    if not still_open.isEmpty():
        similar = similar_titles(still_open, anchored, threshold, tolerance)
        similar = similar.groupBy("norm", "year").agg(best_of)
        best = best.unionByName(similar).groupBy("norm", "year").agg(F.min("best").alias("best"))
    floats = titled(reps).filter(~F.col("has_tmdb")).select("cluster_key", "norm", "year")
    return (
        lookup_join(floats, best, ["norm", "year"], rows_per_key=reps.count())
        .filter(F.col("best").isNotNull())
        .select("cluster_key", "best.anchor_key", "best.ratio", "best.anchor_year")
    )


def _years(year: Column, tolerance: int) -> Column:
    return F.sequence(year - tolerance, year + tolerance)


def _longest_partner(length: Column, threshold: int) -> Column:
    """Longest title that one of `length` characters can still match."""
    return F.floor(length * F.lit(401 - 2 * threshold) / F.lit(2 * threshold - 1)).cast("int")


def _shortest_partner(length: Column, threshold: int) -> Column:
    return F.ceil(length * F.lit(2 * threshold - 1) / F.lit(401 - 2 * threshold)).cast("int")


def _edits(length: Column, threshold: int) -> Column:
    """Most edits that can lie between a title of this length and any partner."""
    return distance_bound(length + _longest_partner(length, threshold), threshold)


def _segment_length(length: Column, threshold: int) -> Column:
    return F.greatest(F.lit(1), F.floor(length / (_edits(length, threshold) + 1)).cast("int"))


def _key_count(length: Column, threshold: int) -> Column:
    """How many segments of a title must be keys. Single characters survive insertions, and as many as the shortest
    partner must share with the title survive at all."""
    least = length + _shortest_partner(length, threshold)
    shared = F.ceil((least - distance_bound(least, threshold)) / 2).cast("int")
    return F.when(_segment_length(length, threshold) > 1, _edits(length, threshold) + 1).otherwise(length - shared + 1)


def _segment_key(year: Column, size: Column, text: Column) -> Column:
    """Keys are hashes to keep the shuffle narrow; a collision only adds a candidate that is verified."""
    return F.xxhash64(year.cast("bigint"), size, text)


def _words(side: str) -> list[Column]:
    return [F.col(f"{side}{n}") for n in range(PROFILE_WORDS)]


def _profiled(titles: DataFrame, text: str, side: str) -> DataFrame:
    """`titles` with the words of the profile of `text` as columns of their own."""
    titles = titles.withColumn("profile", profile(F.col(text)))
    return titles.withColumns({f"{side}{n}": F.col("profile")[n] for n in range(PROFILE_WORDS)}).drop("profile")


def _index(anchored: DataFrame, floating: DataFrame, threshold: int, tolerance: int) -> DataFrame:
    """The rarest segments of every anchored title that some floating title of about its year may match by length.

    Returns a row for each different segment of a title and year around it, with the first and the last place where it
    begins and `nth`, its rank by rarity: one more segments than there are edits are enough, and the edits between a title and one
    partner are fewer than those that any partner may need. Single characters have rank zero, as all of them count.
    """
    lengths = floating.filter(F.length("norm") > 0).select("year", F.length("norm").alias("lb")).distinct()
    partners = F.sequence(_shortest_partner(F.col("lb"), threshold), _longest_partner(F.col("lb"), threshold))
    wanted = lengths.select("lb", F.explode(_years(F.col("year"), tolerance)).alias("anchor_year")).distinct()
    wanted = wanted.select("anchor_year", F.explode(partners).alias("la")).distinct()
    titles = anchored.withColumn("la", F.length("anchor_norm")).filter("la > 0").join(wanted, ["anchor_year", "la"], "left_semi")
    titles = titles.withColumn("size", _segment_length(F.col("la"), threshold)).withColumn("id", F.monotonically_increasing_id())
    titles = cut_lineage(_profiled(titles, "anchor_norm", "a"))
    starts = F.sequence(F.lit(0), F.floor(F.col("la") / F.col("size")).cast("int") - 1)
    segments = titles.select("id", "la", "size", "anchor_norm", F.explode(starts).alias("i"))
    segments = segments.select("id", "la", "size", (F.col("i") * F.col("size")).alias("start"), F.substring(F.col("anchor_norm"), F.col("i") * F.col("size") + 1, F.col("size")).alias("text"))
    rarity = segments.groupBy("size", "text").agg(F.count(F.lit(1)).alias("n"))
    ranked = lookup_join(segments, rarity, ["size", "text"]).groupBy("id", "la", "size")
    ranked = ranked.agg(F.sort_array(F.collect_list(F.struct("n", "text", "start"))).alias("all"))  # segments of one title
    rarest = F.slice("all", F.lit(1), _key_count(F.col("la"), threshold))
    keys = ranked.select("id", "size", F.posexplode(rarest).alias("at", "x"))
    nth = F.when(F.first("size") == 1, F.lit(0)).otherwise(F.min("at") + 1)
    keys = keys.groupBy("id", "x.text").agg(F.min("x.start").alias("first_place"), F.max("x.start").alias("last_place"), nth.alias("nth"))
    return (
        titles.join(keys, "id")
        .withColumn("near_year", F.explode(_years(F.col("anchor_year"), tolerance)))
        .select(
            _segment_key(F.col("near_year"), F.col("size"), F.col("text")).alias("segment"),
            "anchor_norm", "anchor_year", "anchor", "la", "first_place", "last_place", "nth", *_words("a"),
        )
    )


def _probes(floating: DataFrame, threshold: int) -> DataFrame:
    """Every different substring of a floating title, of each length that segments of its partners can have.

    A row has the first and the last place where the substring begins, so there are at most as many rows as characters for each
    segment length, and partners have few segment lengths.
    """
    tasks = int(floating.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lb, size = F.col("lb"), F.col("size")
    partners = F.sequence(_shortest_partner(lb, threshold), _longest_partner(lb, threshold))
    titles = floating.withColumn("lb", F.length("norm")).filter("lb > 0").repartition(tasks, "norm", "year")
    probes = _profiled(titles, "norm", "b").withColumn("size", F.explode(F.array_distinct(F.transform(partners, lambda la: _segment_length(la, threshold)))))
    places = F.sequence(F.lit(0), lb - size)
    texts = F.transform(places, lambda i: F.struct(F.substring(F.col("norm"), i + 1, size).alias("text"), i.alias("i")))
    probes = probes.filter(size <= lb).withColumn("x", F.explode(texts))
    probes = probes.groupBy("norm", "year", "lb", "size", "x.text", *_words("b"))
    probes = probes.agg(F.min("x.i").alias("first_found"), F.max("x.i").alias("last_found"))
    segment = _segment_key(F.col("year"), size, F.col("text")).alias("segment")
    return probes.select(segment, "norm", "year", "lb", "first_found", "last_found", *_words("b"))
