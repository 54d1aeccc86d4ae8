"""MinHash near-dedup by an inverted join on signature coordinates.

Every document is a set of k-word shingles, signed with K minima; equal sets become one representative
first. A representative is posted under its (coordinate, value) pairs that others have as well, rarest
first: two documents that agree on T of K coordinates agree on one of the first n - T + 1 of n shared
pairs already (prefix), and a document with fewer than T shared pairs agrees with nobody (skip). Within
a posting, collisions are counted against whole signatures, and documents of T or more are gathered into
candidate clusters. The documents of a posting that is too long for that are one cluster, unseen.

Links are decided on the full shingle sets within the clusters. A cluster of more than BLOCK sets is dealt
into blocks, each with a few pivots of the cluster: that links nearly all that is dense. A set that is not
in the largest component then has to be compared with all blocks, unless too many of its shingles are its
own to link with anything. Blocks travel as one row; no step emits all pairs of a group, all return forests.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm import words
from kinfold.llm.common import NO_ID, cut, partitions, real_id, released, slices, small, texts_of, utf8
from kinfold.llm.components import components, with_least

#: A posting of more documents is one candidate cluster.
LONG = 1000
#: Sets of a block of a cluster, and the pivots that each block of a larger cluster has besides.
BLOCK, PIVOTS = 256, 4


def match_threshold(coordinates: int, percent: int) -> int:
    """Matches that a pair at the similarity reaches but for at most one pair in 30,000, by the binomial."""
    s, missed = percent / 100, 0.0
    for matches in range(coordinates + 1):
        missed += math.comb(coordinates, matches) * s**matches * (1 - s) ** (coordinates - matches)
        if missed > 1 / 30_000:
            return max(2, matches)
    return coordinates


def _sets(column: pa.Array, k: int):
    """Ranges of rows with their shingle sets: (first row, last row, flat, offsets)."""
    data, at = utf8(column)
    for i, j in slices(at, 1 << 19):
        part, own = words.lowered(data[at[i] : at[j]]), at[i : j + 1] - at[i]
        starts, ends, counts = words.spans(part, own)
        yield i, j, *words.shingles(words.hashes(part, starts, ends), counts, k)


def signatures(docs: DataFrame, k: int, coordinates: int) -> DataFrame:
    """doc_id, h (a hash of the text), n_shingles, two 64-bit sums that name the set, and the signature (null for an empty set)."""
    rng = np.random.default_rng(20240517)
    factors = rng.integers(1, 2**63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 2**63, coordinates, dtype=np.uint64)

    def sign(batches):
        for batch in batches:
            for i, j, flat, at in _sets(batch.column("text"), k):
                size = np.diff(at)
                full = np.flatnonzero(size)
                sig = np.zeros((len(full), coordinates), np.int32)
                one, two = np.zeros(j - i, np.int64), np.zeros(j - i, np.int64)
                if len(full):
                    heads = at[:-1][full]
                    one[full] = np.add.reduceat(words.mix(flat + np.uint64(11)), heads).view(np.int64)
                    two[full] = np.add.reduceat(words.mix(flat ^ np.uint64(0xA5A5A5A55A5A5A5A)), heads).view(np.int64)
                    for a, b in slices(np.append(heads, len(flat)), 1 << 16):
                        lo = heads[a]
                        hi = heads[b] if b < len(heads) else len(flat)
                        some, own = flat[lo:hi], heads[a:b] - lo
                        for c in range(coordinates):
                            least = np.minimum.reduceat((some * factors[c] + shifts[c]) >> np.uint64(32), own)
                            sig[a:b, c] = least.astype(np.uint32).view(np.int32)
                ends = np.concatenate(([0], np.cumsum((size > 0) * coordinates))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(sig.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), batch.column("h").slice(i, j - i), pa.array(size), pa.array(one), pa.array(two), lists],
                    names=["doc_id", "h", "n_shingles", "one", "two", "sig"],
                )

    return docs.mapInArrow(released(sign), "doc_id long, h long, n_shingles long, one long, two long, sig array<int>")


def _groups(batches, keys: list[str]):
    """Tables of whole groups from batches that are sorted by the keys, many groups at a time; the keys numbered."""
    held: list[pa.RecordBatch] = []
    last = None

    def numbered(table: pa.Table):
        change = np.zeros(table.num_rows, bool)
        for name in keys:
            x = table.column(name).to_numpy()
            change[1:] |= x[1:] != x[:-1]
        return table, np.cumsum(change)

    for batch in batches:
        if not batch.num_rows:
            continue
        own = [batch.column(name).to_numpy(zero_copy_only=False) for name in keys]
        change = np.zeros(batch.num_rows, bool)
        for i, x in enumerate(own):
            change[1:] |= x[1:] != x[:-1]
            change[0] |= last is not None and x[0] != last[i]
        last = [x[-1] for x in own]
        if change.any():  # all before the last group's start is whole
            at = int(np.flatnonzero(change)[-1])
            whole = [*held, batch.slice(0, at)] if at else held
            yield numbered(pa.Table.from_batches(whole))
            held, batch = [], batch.slice(at)
        held.append(batch)
    if held:
        yield numbered(pa.Table.from_batches(held))


def _sorted(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.repartition(partitions(rows), *keys).sortWithinPartitions(*keys)


def _linked(ids: np.ndarray, alike) -> tuple[list[int], list[int]]:
    """A forest over the rows that are alike; alike(i, others) marks the others that are like row i."""
    a, b = [], []
    left = np.arange(len(ids))
    while len(left):
        root, left = left[0], left[1:]
        found = [root]
        while found and len(left):
            i = found.pop()
            hit = alike(i, left)
            if hit.any():
                new = left[hit]
                a += ids[new].tolist()
                b += [int(ids[root])] * len(new)
                found += new.tolist()
                left = left[~hit]
    return a, b


def _candidates(rows: DataFrame, keys: list[str], enough: int) -> DataFrame:
    """a, b: links that join the documents of each group which agree on enough coordinates. rows: keys, doc_id, sig."""

    def search(batches):
        for held, group in _groups(batches, keys):
            ids = held.column("doc_id").to_numpy()
            lists = held.column("sig").combine_chunks()
            sig = lists.flatten().to_numpy().reshape(len(ids), -1)
            size = np.bincount(group)
            short = size[group] <= 8
            a, b = [], []
            for d in range(1, 8):  # short groups all at once
                r = np.flatnonzero(short[:-d] & (group[:-d] == group[d:]))
                for r in np.array_split(r, len(r) // 50_000 + 1):
                    r = r[(sig[r] == sig[r + d]).sum(1) >= enough]
                    a += ids[r].tolist()
                    b += ids[r + d].tolist()
            start = np.cumsum(size) - size
            for g in np.flatnonzero(size > 8).tolist():
                own = sig[start[g] : start[g] + size[g]]
                turned = np.ascontiguousarray(own.T)

                def alike(i, others, own=own, turned=turned):
                    if len(others) == len(own):
                        return (turned == own[i][:, None]).sum(0) >= enough
                    return (turned[:, others] == own[i][:, None]).sum(0) >= enough

                more = _linked(ids[start[g] : start[g] + size[g]], alike)
                a += more[0]
                b += more[1]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return _sorted(rows, keys).mapInArrow(released(search), "a long, b long").distinct()


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets share, by products of slices of their incidence matrix."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    column = np.unique(flat, return_inverse=True)[1]
    often = np.bincount(column) > 1
    column, owner = (np.cumsum(often) - 1)[column[often[column]]], owner[often[column]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = int(often.sum())
    for lo in range(0, total, 4096):
        a, b = np.searchsorted(column, (lo, lo + 4096))
        part = np.zeros((len(sets), min(4096, total - lo)), np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        out += part @ part.T
    return out


def _forest(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[list[int], list[int]]:
    """Links that join the sets that are `percent` alike."""
    if len(sets) < 2:
        return [], []
    size = np.array([len(x) for x in sets], np.float64)
    same = _common(sets)
    linked = 100 * same >= percent * (size[:, None] + size[None, :] - same)
    return _linked(ids, lambda i, others: linked[i, others])


#: Sets that travel in one row: their names, their sizes and their elements end to end.
PACKED = "ids array<long>, sizes array<int>, flat array<long>"


def _unpacked(held: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Names and sets of all rows, and the number of each row's first set."""
    ids, sizes, flat = (held.column(c).combine_chunks() for c in ("ids", "sizes", "flat"))
    first = np.concatenate(([0], np.cumsum(ids.value_lengths().to_numpy())))
    ends = np.cumsum(sizes.flatten().to_numpy())
    return ids.flatten().to_numpy(), np.split(flat.flatten().to_numpy(), ends[:-1]) if len(ends) else [], first


def _confirmed(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """a, b: links that join the sets of each group that are alike. rows: keys and PACKED."""

    def decide(batches):
        for held, group in _groups(batches, keys):
            ids, sets, first = _unpacked(held)
            a, b = [], []
            ends = np.append(np.flatnonzero(np.diff(group)) + 1, len(group))
            for lo, hi in zip(first[np.concatenate(([0], ends[:-1]))].tolist(), first[ends].tolist(), strict=True):
                more = _forest(ids[lo:hi], sets[lo:hi], percent)
                a += more[0]
                b += more[1]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return _sorted(rows, keys).mapInArrow(released(decide), "a long, b long").filter("a != b").distinct()


def _packed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The sets of each group as one row. rows: long keys and PACKED."""

    def pack(batches):
        for held, group in _groups(batches, keys):
            start = np.flatnonzero(np.diff(group, prepend=-1))
            columns = [held.column(c).combine_chunks().take(pa.array(start)) for c in keys]
            for c in ("ids", "sizes", "flat"):
                lists = held.column(c).combine_chunks()
                ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
                columns.append(pa.ListArray.from_arrays(pa.array(ends[np.append(start, len(group))].astype(np.int32)), lists.flatten()))
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "ids", "sizes", "flat"])

    return _sorted(rows, keys).mapInArrow(released(pack), ", ".join(f"{k} long" for k in keys) + ", " + PACKED)


def _of_texts(rows: DataFrame, k: int) -> DataFrame:
    """root, n, rep and PACKED, a row for each text. rows: root, n, rep, text."""

    def read(batches):
        for batch in batches:
            for i, j, flat, at in _sets(batch.column("text"), k):
                own = [batch.column(c).slice(i, j - i) for c in ("root", "n", "rep")]
                one = pa.array(np.arange(j - i + 1, dtype=np.int32))
                lists = [pa.ListArray.from_arrays(one, own[2]), pa.ListArray.from_arrays(one, pa.array(np.diff(at).astype(np.int32)))]
                lists.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat.view(np.int64))))
                yield pa.RecordBatch.from_arrays([*own, *lists], names=["root", "n", "rep", "ids", "sizes", "flat"])

    return rows.mapInArrow(released(read), "root long, n long, rep long, " + PACKED)


def _clusters(reps: DataFrame, coordinates: int, enough: int) -> DataFrame:
    """node, root: candidate clusters of representatives (doc_id, sig), without their roots."""
    token = lambda v, j: F.shiftleft(j.cast("long"), 32).bitwiseOR(v.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    tokens = reps.select("doc_id", F.explode(F.transform("sig", token)).alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # at most K pairs a document, rarest first
    own = tokens.join(shared, "token").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("t")).filter(F.size("t") >= enough)
    posted = cut(own.select("doc_id", F.explode(F.slice("t", F.lit(1), F.size("t") - (enough - 1))).alias("t")).select("doc_id", "t.token", "t.n"))
    short = _candidates(posted.filter(F.col("n") <= LONG).select("token", "doc_id").join(reps, "doc_id"), ["token"], enough)
    long = posted.filter(F.col("n") > LONG)
    if long.isEmpty():
        return components(short)
    pivot = cut(long.groupBy("token").agg(F.min("doc_id").alias("b")))  # of at most a LONG-th of the postings
    whole = long.join(small(pivot), "token").select(F.col("doc_id").alias("a"), "b").filter("a != b")
    return components(short.unionByName(whole.distinct()))


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """a, b: a forest of the links within clusters. sets: root, n (of the cluster), rep and PACKED."""
    little = _confirmed(sets.filter(F.col("n") <= BLOCK), ["root"], percent)
    large = sets.filter(F.col("n") > BLOCK)
    if large.isEmpty():
        return cut(little)
    held = F.ceil(F.col("n") / BLOCK)
    blocked = large.withColumn("x", F.pmod(F.xxhash64("rep"), held))
    least = [F.min(F.struct(F.xxhash64("rep", F.lit(i)), F.col("rep").alias("rep"))).alias(f"p{i}") for i in range(PIVOTS - 1)]
    pivots = large.groupBy("root").agg(*least).select(F.explode(F.array_distinct(F.array("root", *[F.col(f"p{i}.rep") for i in range(PIVOTS - 1)]))).alias("rep"))
    pivots = large.join(small(cut(pivots)), "rep").withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), held - 1)))
    columns = ["root", "x", "ids", "sizes", "flat"]
    dense = cut(_confirmed(blocked.select(columns).unionByName(pivots.select(columns)), ["root", "x"], percent))
    first = dense.unionByName(little)

    # sets outside the largest component of their cluster may link with any other block
    top = components(dense).withColumnRenamed("root", "top")
    members = large.select("root", "rep", F.get("sizes", F.lit(0)).alias("size")).join(top, F.col("rep") == F.col("node"), "left")
    members = cut(members.select("root", "rep", "size", F.coalesce("top", "rep").alias("top")))
    main = members.groupBy("root", "top").agg(F.count(F.lit(1)).alias("c"), F.min("size").alias("s"))
    main = cut(main.groupBy("root").agg(F.max_by("top", "c").alias("main"), F.min("s").alias("smallest"), F.count(F.lit(1)).alias("parts")).filter("parts > 1"))
    if main.isEmpty():
        return cut(first)
    single = large.join(small(main.select("root")), "root").select("root", "rep", F.explode("flat").alias("x"))
    single = single.groupBy("root", "x").agg(F.count(F.lit(1)).alias("c"), F.min("rep").alias("rep")).filter("c = 1").groupBy("rep").agg(F.count(F.lit(1)).alias("own"))
    # a partner shares at least percent / (100 + percent) of both sizes, and is no smaller than percent of this one
    partner = F.greatest(F.col("smallest"), F.ceil(F.col("size") * percent / 100))
    able = (F.col("size") - F.coalesce("own", F.lit(0))) * (100 + percent) >= percent * (F.col("size") + partner)
    open_ = members.join(small(main), "root").join(single, "rep", "left").filter(able)
    open_ = cut(open_.select("root", "rep", (F.col("top") != F.col("main")).alias("apart")))
    counts = cut(open_.groupBy("root").agg(F.count_if("apart").alias("strays"), F.count(F.lit(1)).alias("all")).filter("strays > 0"))
    if counts.isEmpty():
        return cut(first)
    blocks = lambda c: F.ceil(F.col(c) / BLOCK)
    spread = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), blocks(c) - 1))
    wanted = cut(open_.join(small(counts), "root").select("rep", "apart", "strays", "all"))
    rows = large.drop("n").join(small(wanted), "rep")
    rows = cut(rows.withColumns({"x": F.pmod(F.xxhash64("rep"), blocks("strays")), "y": F.pmod(F.xxhash64("rep"), blocks("all"))}))
    keys = ["root", "strays", "all"]
    strays = _packed(rows.filter("apart").select(*keys, "x", "ids", "sizes", "flat"), [*keys, "x"]).withColumn("y", spread("all"))
    others = _packed(rows.select(*keys, "y", "ids", "sizes", "flat"), [*keys, "y"]).withColumn("x", spread("strays"))
    columns = ["root", "x", "y", "ids", "sizes", "flat"]
    return cut(first.unionByName(_confirmed(strays.select(columns).unionByName(others.select(columns)), ["root", "x", "y"], percent)))


class Linked:
    """The rows of docs with their sets, and the components of the sets.

    docs: doc_id and text, other columns are ignored. Every distinct set is compared. A set is named by the smallest
    doc_id that has it; where that id has several sets (null ids are all one id), the others count down from the
    largest long, so that they are no component's root while a document's id is in it.
    """

    def __init__(self, docs: DataFrame, shingle: int, percent: int, coordinates: int):
        docs = texts_of(docs).withColumn("h", F.xxhash64("text"))
        enough = match_threshold(coordinates, percent)
        #: doc_id, h (a hash of the text), n_shingles, one, two (which name the set) and sig of every row
        self.signed = cut(signatures(docs, shingle, coordinates))
        key = ["n_shingles", "one", "two"]
        filled = self.signed.filter("n_shingles > 0")
        owners = filled.groupBy(*key).agg(F.min(F.struct("doc_id", "h")).alias("first")).select(*key, F.col("first.doc_id").alias("low"), "first.h")
        owners = cut(owners.withColumn("extra", F.lit(2**63 - 1) - F.monotonically_increasing_id()))
        again = owners.filter(F.col("low") != NO_ID).groupBy("low").agg(F.count(F.lit(1)).alias("sets"), F.min("extra").alias("other")).filter("sets > 1")
        owners = owners.join(again.select("low", "other"), "low", "left")
        plain = (F.col("low") != NO_ID) & (F.col("other").isNull() | (F.col("extra") == F.col("other")))
        #: the sets: key, low and h of their first row, rep (their name)
        self.owners = cut(owners.select(*key, "low", "h", F.when(plain, F.col("low")).otherwise(F.col("extra")).alias("rep")))
        #: doc_id, h, rep of every row that has a set
        self.member = filled.select("doc_id", "h", *key).join(self.owners.select(*key, "rep"), key).select("doc_id", "h", "rep")
        first = self.owners.select(*key, F.col("low").alias("doc_id"), "h", "rep")
        reps = cut(filled.join(first, [*key, "doc_id", "h"]).select(F.col("rep").alias("doc_id"), "sig").dropDuplicates(["doc_id"]))
        near = _clusters(reps, coordinates, enough)
        near = near.union(near.select("root", "root").distinct()).toDF("rep", "root")
        # only the sizes of large clusters matter: of those there are at most a BLOCK-th of the sets
        large = cut(near.groupBy("root").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK))
        near = near.join(small(large), "root", "left").withColumn("n", F.coalesce("n", F.lit(1)))
        wanted = cut(first.select("doc_id", "h", "rep").join(near, "rep"))
        texts = docs.join(small(wanted), ["doc_id", "h"]).select("root", "n", "rep", "text").dropDuplicates(["rep"])
        #: a, b: links of sets
        self.links = _links(cut(_of_texts(texts, shingle)), percent)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, coordinates: int = 32) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept, for every row of docs.

    docs: doc_id and text, other columns are ignored, whatever their names. Null texts and texts without words have
    no shingles and link with nothing; equal sets are always linked; a null doc_id counts as the smallest. Rows that
    repeat a doc_id are one document: they share its component, as do rows of null ids only where their sets are
    linked. A text of any length is read whole, 1 MB of texts at a time. Ties don't occur: ids decide. An empty
    table gives an empty result.
    """
    found = Linked(docs, shingle, percent, coordinates)
    member, links = cut(found.member.select("doc_id", "rep")), found.links
    several = member.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("top")).filter((F.col("doc_id") != NO_ID) & (F.col("b") < F.col("top")))
    several = cut(several.drop("top"))
    if not several.isEmpty():
        links = links.unionByName(member.join(small(several), "doc_id").filter("rep != b").select(F.col("rep").alias("a"), "b").distinct())
    roots = components(links)
    named = member.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").select("doc_id", F.coalesce("root", "rep").alias("top"))
    nulls = found.owners.filter(F.col("low") == NO_ID)
    if not nulls.isEmpty():  # components that hold a set of a null id are that id's, which counts as the smallest
        nulls = nulls.select(F.col("rep").alias("node")).join(roots, "node", "left").select(F.coalesce("root", "node").alias("top")).distinct()
        nulls = cut(nulls.withColumn("null", F.lit(NO_ID)))
        named = named.join(small(nulls), "top", "left").select("doc_id", F.coalesce("null", "top").alias("top"))
    whole = named.groupBy("doc_id").agg(F.min("top").alias("root"))
    out = found.signed.select("doc_id", "n_shingles").join(whole, "doc_id", "left")
    out = out.withColumn("component", F.coalesce("root", "doc_id"))
    return out.select(real_id(), "n_shingles", F.nullif("component", F.lit(NO_ID)).alias("component_id"), (F.col("doc_id") == F.col("component")).alias("kept"))


def first_copies(docs: DataFrame, shingle: int = 5, percent: int = 80, coordinates: int = 32) -> DataFrame:
    """The rows of docs without near copies: of each group of linked texts one row stays, of the smallest doc_id (null
    is the smallest), of equal ids the one of the smallest hash of the text.

    All columns of docs stay as they are. Rows that repeat an id are documents of their own: those of unlinked texts all
    stay, and of exact repeats one does. Texts without words are no copies of anything and stay.
    """
    found = Linked(docs, shingle, percent, coordinates)
    top = found.member.join(components(found.links).withColumnRenamed("node", "rep"), "rep", "left").withColumn("top", F.coalesce("root", "rep"))
    top = cut(top.select("doc_id", "h", F.col("top").alias("a")))
    rows = with_least(top, top, F.min(F.struct("doc_id", "h")), top.count()).select("doc_id", "h", (F.struct("doc_id", "h") != F.col("m")).alias("gone"))
    rows = cut(rows.groupBy("doc_id", "h").agg(F.max("gone").alias("gone"), (F.count(F.lit(1)) > 1).alias("again")).filter("gone OR again"))
    rows = rows.select(F.col("doc_id").alias("_kinfold_id"), F.col("h").alias("_kinfold_h"), F.col("gone").alias("_kinfold_gone"))
    key = (F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) == F.col("_kinfold_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_kinfold_h"))
    marked = docs.join(small(rows), key, "left")
    plain = marked.filter("_kinfold_id IS NULL").select(*docs.columns)
    once = marked.filter("NOT _kinfold_gone").dropDuplicates(["_kinfold_id", "_kinfold_h"]).select(*docs.columns)
    return plain.unionByName(once)
