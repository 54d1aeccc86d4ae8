"""Document fingerprints by winnowing, in DataFrame functions only.

A text's units are its words in lower case (runs without ASCII white space; longer ones are cut every
CUT characters, so that texts without spaces have units too). Every K units in a row have a hash;
of every WINDOW hashes in a row the smallest is kept, the rightmost of equals, with its position. Two
texts that share K + WINDOW - 1 units in a row therefore share a fingerprint.

Hash and position travel in one number: 34 bits of hash above 30 bits of inverted position, so that
the smallest number is the smallest hash and, of equal hashes, the rightmost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinfold.llm.common import cut, real_id, small, texts_of

K, WINDOW, CUT = 3, 6, 24
#: Consecutive document ids that are put in order in one group; quantiles of the ids; bits of a run's number in its segment.
RUN, SEGMENTS, RUN_BITS = 512, 64, 40
_LAST = (1 << 30) - 1


def units(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[^ \t\n\x0B\f\r]{1,%d}" % CUT), F.lit(0))


def selected(text: Column) -> Column:
    """array<long>: the chosen hashes with their positions, in the order of the text. A text without units has none."""
    hashed = F.transform(units(text), lambda w: F.xxhash64(w))

    # of fewer than K units the whole sequence is the one gram
    def grams(h: Column) -> Column:
        n = F.greatest(F.size(h) - (K - 1), F.least(F.size(h), F.lit(1)))

        def gram(i: Column) -> Column:
            mixed = F.xxhash64(*[F.get(h, i + j) for j in range(K)])
            return F.shiftleft(mixed, 30).bitwiseOR(F.lit(_LAST) - i)

        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), gram)).otherwise(F.array().cast("array<bigint>"))

    def least(g: Column) -> Column:
        n = F.greatest(F.size(g) - (WINDOW - 1), F.least(F.size(g), F.lit(1)))

        def smallest(i: Column) -> Column:
            return F.least(*[F.get(g, i + j) for j in range(WINDOW)])  # least() passes over what is beyond the end

        return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(0), n - 1), smallest))).otherwise(F.array().cast("array<bigint>"))

    return _let(hashed, lambda h: _let(grams(h), least))


def _let(value: Column, body) -> Column:
    """body(value) with value computed once: higher-order functions would compute it anew for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hashes(chosen: Column) -> Column:
    """The set of the chosen hashes, without positions."""
    return F.array_distinct(F.transform(chosen, lambda x: F.shiftright(x, 30)))


def printed(chosen: Column) -> Column:
    """position:hash, comma-joined."""
    return F.array_join(F.transform(chosen, lambda x: F.concat((F.lit(_LAST) - x.bitwiseAND(F.lit(_LAST))).cast("string"), F.lit(":"), F.lower(F.hex(F.shiftright(x, 30).bitwiseAND(F.lit((1 << 34) - 1)))))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes; two empty sets are alike."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / both)


def run_of(docs: DataFrame) -> Column:
    """The number of the run of about RUN ids that a doc_id belongs to; numbers ascend with ids, dense or not.

    The ids' range is cut at SEGMENTS quantiles; a segment's runs are as wide as its own spacing asks for. The driver sees
    the quantiles, and the number above RUN_BITS bits is the segment.
    """
    shares = [i / SEGMENTS for i in range(1, SEGMENTS)]
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.percentile_approx("doc_id", shares, 10_000).alias("q")).first()
    if not row["n"]:
        return F.lit(0).cast("long")
    edges = sorted({row["lo"], *row["q"]})
    ends = [*edges[1:], row["hi"] + 1]

    def leaf(i: int) -> Column:
        width = max(1, (ends[i] - edges[i]) * RUN * len(edges) // row["n"])
        first = edges[i] // width if edges[i] >= 0 else -(-edges[i] // width)  # div cuts towards zero
        return F.lit(i << RUN_BITS) + F.expr(f"doc_id div {width}L" if width < 1 << 63 else "0L") - F.lit(first if width < 1 << 63 else 0)

    def among(i: int, j: int) -> Column:
        half = (i + j) // 2
        return leaf(i) if j - i == 1 else F.when(F.col("doc_id") < edges[half], among(i, half)).otherwise(among(half, j))

    return among(0, len(edges)).cast("long")


def with_next(docs: DataFrame, derive, columns: list[str]) -> DataFrame:
    """derive(docs) with next_<column> of the next row by ascending doc_id (after the last: the first).

    Rows are grouped by runs of ids; the first row of every run is copied to the run before it, so that no task sees more
    than a run. Only run numbers, one for about RUN ids, are put in order, first within their segment of the ids and
    then (one row for each of at most SEGMENTS) between segments.
    """
    run = run_of(docs)
    firsts = docs.groupBy(run.alias("run")).agg(F.min("doc_id").alias("doc_id"))
    far = firsts.withColumn("far", F.shiftright("run", RUN_BITS))
    edge = far.groupBy("far").agg(F.min("run").alias("first_run"))
    whole = Window.orderBy("far").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edge = edge.select("far", F.lead("first_run").over(Window.orderBy("far")).alias("after"), F.first("first_run").over(whole).alias("zero"))
    inner = far.withColumn("next_run", F.lead("run").over(Window.partitionBy("far").orderBy("run")))
    following = inner.join(edge.select("far", F.coalesce("after", "zero").alias("after")), "far").select("run", F.coalesce("next_run", "after").alias("next_run"))
    # the first row of next_run is wanted in run; only these few rows are read again
    copies = cut(firsts.join(following.select(F.col("next_run").alias("run"), F.col("run").alias("to")), "run").select("doc_id", "to"))
    copied = derive(docs.join(small(copies), "doc_id")).groupBy("to").agg(F.min(F.struct("doc_id", *columns)).alias("r"))
    copied = copied.select(F.col("r.doc_id").alias("doc_id"), *[F.col(f"r.{c}").alias(c) for c in columns], F.col("to").alias("run"), F.lit(1).alias("extra"))
    rows = derive(docs.withColumn("run", run)).select("doc_id", *columns, "run", F.lit(0).alias("extra")).unionByName(copied)
    order = Window.partitionBy("run").orderBy("extra", "doc_id", *columns)
    return rows.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]).filter("extra = 0")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    Null texts are empty, an empty text has the fingerprint '' and is like another empty one only. Rows that
    repeat a doc_id stand next to each other by text; a null doc_id comes first. Of equal hashes in a window the
    rightmost is kept. Texts of any length are read whole. An empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    # fingerprints need no neighbours: they are made before the one shuffle of the texts
    rows = with_next(texts_of(docs), lambda d: d.withColumn("chosen", selected(F.col("text"))), ["text", "chosen"])
    n = F.char_length("text")
    tail = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - tail), F.substring(F.col("next_text"), F.lit(1), tail))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "chosen", "next_chosen")
    rows = rows.withColumn("edited_chosen", selected(F.col("edited")))
    own = hashes(F.col("chosen"))
    return rows.select(
        real_id(),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("chosen")).alias("fingerprint"),
        printed(F.col("edited_chosen")).alias("edited_fingerprint"),
        likeness(own, hashes(F.col("edited_chosen"))).alias("near_edited"),
        likeness(own, hashes(F.col("next_chosen"))).alias("near_next"),
    )
