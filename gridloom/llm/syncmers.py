"""Document fingerprints of closed syncmers, by DataFrame functions only.

The letters are words (runs of other characters than space and the controls from tab to carriage return). A run of ``K``
words is an anchor when the least hash among its runs of ``S`` words is that of the first or the last: the choice depends
on the run alone, so the same passage has the same anchors wherever it stands. Texts are padded by ``K - 1`` marks on both sides,
so the shortest has anchors, too.

A fingerprint holds every anchor of the whole text with its place. Of any ``K - S`` runs that follow each other one is an anchor, so
anchors overlap and leave out no word. The likeness of two texts is the share of their words that lie in anchors of both, where
the anchors are matched one to one by hash and place; see ``likeness``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.llm.common import SPACE, given_id, identified

K, S = 5, 2
#: Added to the places of the second of two texts, so that those of the first come before them.
_SECOND = 1 << 32
#: Documents in one range of ids, and the most ranges.
RANGE_ROWS, MOST_RANGES = 4000, 100_000
_PART = 256


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _anchored(text: Column, make, k: int, s: int) -> Column:
    """``make(position, grams)`` for every anchor of the text."""
    marks = F.array_repeat(F.lit(0).cast("long"), k - 1)
    words = F.concat(marks, F.transform(F.split(text, SPACE), lambda w: F.xxhash64(w)), marks)
    inner = k - s  # the last run of s words within k begins here

    def grams(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - s), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(s))))

    def chosen(g: Column) -> Column:
        def closed(i: Column) -> Column:
            middle = [F.get(g, i + j) for j in range(1, inner)]
            return F.least(F.get(g, i), F.get(g, i + inner)) <= F.least(*middle) if len(middle) > 1 else F.least(F.get(g, i), F.get(g, i + inner)) <= middle[0]

        return F.transform(F.filter(F.sequence(F.lit(0), F.size(g) - 1 - inner), closed), lambda i: make(i, g))

    return _bind(words, lambda h: _bind(grams(h), chosen))


def _anchor_hash(i: Column, g: Column, k: int, s: int) -> Column:
    steps = sorted({*range(0, k - s, s), k - s})
    return F.xxhash64(*(F.get(g, i + j) for j in steps))


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """The fingerprint of a text that is not null: all anchors with their places, ``array<struct<position, hash>>``, in order.

    The position is that of the first word; it is negative where the anchor begins in the padding.
    """
    return _anchored(text, lambda i, g: F.struct((i - (k - 1)).alias("position"), _anchor_hash(i, g, k, s).alias("hash")), k, s)


def as_text(prints: Column) -> Column:
    """A fingerprint as words ``position:hash``, the hash in hexadecimal digits."""
    return F.lower(F.array_join(F.transform(prints, lambda x: F.concat(x["position"].cast("string"), F.lit(":"), F.hex(x["hash"]))), " "))


def _pairs(a: Column, b: Column) -> Column:
    """``array<struct<x, y>>``: the places of the first, second, ... occurrence of an anchor in one text and in the other.

    Sorted by hash, then text, then place; equal hashes are a run, of which only the own members are looked at.
    """
    first = F.transform(a, lambda x: F.struct(x["hash"].alias("hash"), x["position"].cast("long").alias("place")))
    second = F.transform(b, lambda x: F.struct(x["hash"].alias("hash"), (x["position"] + F.lit(_SECOND)).alias("place")))

    def runs(m: Column) -> Column:
        starts = F.filter(F.transform(m, lambda x, i: F.when((i == 0) | (F.get(m, i - 1)["hash"] != x["hash"]), i)), lambda i: i.isNotNull())
        return _bind(starts, lambda begin: F.flatten(F.transform(begin, lambda i, j: matched(m, i, F.coalesce(F.get(begin, j + 1), F.size(m))))))

    def matched(m: Column, start: Column, end: Column) -> Column:
        least = F.lit(_SECOND // 2)
        both = (F.get(m, start)["place"] < least) & (F.get(m, end - 1)["place"] >= least)

        def zipped(places: Column) -> Column:
            def seconds(n: Column) -> Column:  # n are of the first text
                mine = F.slice(places, F.lit(1), F.least(n, F.size(places) - n))
                return F.transform(mine, lambda x, i: F.struct(x["place"].alias("x"), (F.get(places, n + i)["place"] - F.lit(_SECOND)).alias("y")))

            return _bind(F.size(F.filter(places, lambda x: x["place"] < least)), seconds)

        none = F.array().cast("array<struct<x:bigint,y:bigint>>")
        return F.when(both, _bind(F.slice(m, start + 1, end - start), zipped)).otherwise(none)

    return _bind(F.sort_array(F.concat(first, second)), runs)


def _covered(pairs: Column, k: int) -> Column:
    """Words from ``x`` on that pairs cover, up to the next pair; none where the next goes back in ``y``."""

    def step(m: Column, x: Column, i: Column) -> Column:
        after = F.get(m, i + 1)
        return F.when(after.isNull(), k).when(after["y"] > x["y"], F.least(F.lit(k), after["x"] - x["x"])).otherwise(0).cast("long")

    return _bind(F.sort_array(pairs), lambda m: F.aggregate(F.transform(m, lambda x, i: step(m, x, i)), F.lit(0).cast("long"), lambda total, n: total + n))


def _span(a: Column, k: int) -> Column:
    return F.element_at(a, -1)["position"] - F.element_at(a, 1)["position"] + k


def likeness(a: Column, b: Column, k: int = K) -> Column:
    """Share of the words of two texts, given by all their anchors, that lie in anchors of both; 0 to 1, the same either way.

    The n-th occurrence of an anchor in one text is matched with the n-th in the other. An anchor stands for its words up to the
    next matched one, unless that comes earlier in the other text. So texts of the same words in the same order have the
    likeness one, one changed word takes off what its anchors cover alone, and a passage that moved counts but for its ends.
    """
    hashes = [F.transform(x, lambda y: y["hash"]) for x in (a, b)]

    def share(pairs: Column) -> Column:
        turned = F.transform(pairs, lambda x: F.struct(x["y"].alias("x"), x["x"].alias("y")))
        return (_covered(pairs, k) + _covered(turned, k)) / (_span(a, k) + _span(b, k))

    return F.when(F.arrays_overlap(*hashes), _bind(_pairs(a, b), share)).otherwise(F.lit(0.0))


def _range_of(bounds: list[int], value: Column) -> Column:
    """How many of the ascending bounds are at most the value, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    parts = [bounds[i : i + _PART] for i in range(0, len(bounds), _PART)]
    firsts = F.array(*(F.lit(p[0]) for p in parts))
    inner = F.array(*(F.array(*(F.lit(b) for b in p)) for p in parts))
    below = F.size(F.filter(firsts, lambda b: b <= value))
    within = F.size(F.filter(F.element_at(inner, F.greatest(below, F.lit(1))), lambda b: b <= value))
    return F.when(below == 0, 0).otherwise((below - 1) * _PART + within)


def with_next(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows ``_id, _text, _range, _guest`` dealt by ranges of ids; the row that follows a range is in it as a guest.

    Ranges are cut at approximate percentiles. Per range one id goes to the driver, whose number is bounded by ``MOST_RANGES``.
    """
    spark = docs.sparkSession
    n = docs.count()
    ranges = max(1, min(MOST_RANGES, -(-n // range_rows)))
    cuts = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(docs.agg(F.percentile_approx("_id", cuts, 100 * ranges)).first()[0] or [])) if cuts and n else []
    ranged = docs.withColumn("_range", _range_of(bounds, F.col("_id")).cast("int"))
    least = sorted(tuple(r) for r in ranged.groupBy("_range").agg(F.min("_id")).collect())
    before = [(first, least[i - 1][0]) for i, (_, first) in enumerate(least)]  # the least of all follows the last range
    follows = spark.createDataFrame(before, "_id long, _before int")
    own = F.struct(F.col("_range"), F.lit(False).alias("_guest"))
    guest = F.struct(F.col("_before").alias("_range"), F.lit(True).alias("_guest"))
    places = F.when(F.col("_before").isNull(), F.array(own)).otherwise(F.array(own, guest))
    placed = ranged.join(F.broadcast(follows), "_id", "left").select("_id", "_text", F.explode(places).alias("place"))
    return placed.select("_id", "_text", "place.*")


def compare_with_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``id_col, n_chars, edited, prints, edited_prints, near_edited, near_next`` of every row.

    The edited text has the last quarter of its characters (rounded down) replaced by the first as many of the next document, or
    all it has. The next has the next larger id (of equal ids, the next larger text); after the last comes the first. A null
    text is empty; a null id counts as the largest and comes back null; repeated rows follow each other; other columns are
    dropped; a single row is followed by itself.
    """
    ranged = with_next(identified(df, id_col, text_col), range_rows)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ranged.repartition(parts, "_range").withColumn("prints", anchors(F.col("_text"), k, s))
    follows = Window.partitionBy("_range").orderBy("_guest", "_id", "_text")
    paired = dealt.select("*", F.lead("_text").over(follows).alias("_next"), F.lead("prints").over(follows).alias("_next_prints")).where("not _guest")
    n = F.char_length("_text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), n - cut), F.substring(F.col("_next"), F.lit(1), cut))
    compared = paired.withColumn("n_chars", n.cast("long")).withColumn("edited", edited).withColumn("edited_prints", anchors(F.col("edited"), k, s))
    return compared.select(
        given_id("_id").alias(id_col), "n_chars", "edited", "prints", "edited_prints",
        likeness(F.col("prints"), F.col("edited_prints"), k).alias("near_edited"), likeness(F.col("prints"), F.col("_next_prints"), k).alias("near_next"),
    )


