"""Near duplicates by bottom-k sketches from one hash function.

Texts with equal shingle sets collapse into one class first. Each class keeps
the k smallest hashes of its set. Inverted lists of the smallest of them give
pairs with a value in common; 256 parity bits of the sketches drop
those whose sketches differ far more than allowed, the Jaccard similarity that
the sketch of the union shows drops most others; the full sets decide the rest.

Values that very many classes retain get no list. Classes that have few others
(texts of common phrases) add lists of runs of two neighbouring values. Where
most of these are kept by very many classes, too, the classes are of the crowd
(families of copies, small sets) and met through their full sets instead: two
sets at the threshold share one of their rarest shingles, and the place of the
first such shingle bounds what they can have in common. Parity bits of the full
sets bound from below how many shingles are in one of two sets only, so members
of a family that are less alike than the threshold are told apart without loss.

A list's pairs are not all formed: first each member is compared with the list's
leader, and all of these pairs are decided; then only pairs of different
components are formed, of which one is not in the list's largest component. Long
lists and other heavy keys are spread over several tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fragloom.llm.common import discard, heavy_keys, join_spread, materialize, read, ready_for_python, sent_if_few, spread_limit
from fragloom.llm.vectext import lists, mix, shingle_sets

#: Hashes that a sketch keeps.
SKETCH = 64
#: Of the smallest LISTED, up to USED that are not frequent have inverted lists; a class with fewer than ENOUGH of these
#: needs runs, as does one of whose smallest LISTED less than RARE are not frequent.
LISTED, USED, ENOUGH, RARE = 32, 16, 14, 20 / 32
#: A value is frequent if more classes keep it among their smallest than SHORT (a list of that length is no work at any size)
#: and than a 1/SHARE of all values kept, so that frequent values are SHARE at most and lists stay the main way as data grow.
#: A set of the crowd and one outside are missed where all that they share is frequent: at 0.8 20 of 32 come from the fifth
#: that is only in one with probability 2e-7. Where 12 of 32 are frequent and common to both, sets at 0.8 still have 0.68 of
#: the others in common, and miss each other less often.
SHORT, SHARE = 100, 1 << 20
#: Of the SKETCH - 1 runs of two values, sets at 0.8 share COMMON or fewer with probability 8e-8 (both ends common, 64 draws
#: of 0.8), so a class with at most COMMON frequent runs meets any other by one that is not frequent.
COMMON = 13
#: Counters of the crowd's shingles (4 MB). Shingles that share one are taken for as frequent as all of them, which costs longer lists but no link.
COUNTERS = 1 << 20
#: Standard deviations of the estimate below the threshold that still lead to the exact test.
MARGIN = 5
#: Parity bits of a sketch, as four numbers.
PARITY = 256
PARTS = ["p0", "p1", "p2", "p3"]
#: Parity bits of a full set of the crowd. They are odd for at most the shingles that are in one of two sets only, so that
#: they rule out for sure; beyond some 1,150 shingles, two sets at 0.8 may differ in more than unlike ones leave odd, and only the bits of the sketch tell.
FULL = 512

_SKETCH_TYPE = "struct<n:bigint,lo:bigint,hi:bigint,p0:bigint,p1:bigint,p2:bigint,p3:bigint,sketch:array<bigint>>"


def _digests(values: np.ndarray, at: np.ndarray) -> list[pa.Array]:
    """Two 64-bit digests of each set, by the order-free sum and xor of mixed values."""
    some = np.flatnonzero(np.diff(at))
    lo, hi = np.zeros(len(at) - 1, np.uint64), np.zeros(len(at) - 1, np.uint64)
    if len(some):
        with np.errstate(over="ignore"):
            lo[some] = np.add.reduceat(mix(values, 1), at[:-1][some])
            hi[some] = np.bitwise_xor.reduceat(mix(values, 2), at[:-1][some])
    return [pa.array(lo.view(np.int64)), pa.array(hi.view(np.int64))]


def _sketcher(words: int, size: int):
    def sketch(texts: pa.Array) -> pa.Array:
        values, at = shingle_sets(texts, words)
        n = np.diff(at)
        kept = np.minimum(n, size)
        to = np.concatenate(([0], np.cumsum(kept)))
        pick = np.arange(to[-1]) - np.repeat(to[:-1] - at[:-1], kept)
        held = values[pick]
        bit = np.repeat(np.arange(len(n)) * PARITY, kept) + (held % np.uint64(PARITY)).astype(np.int64)
        parity = np.packbits(np.bincount(bit, minlength=len(n) * PARITY) & 1).view(np.int64).reshape(-1, len(PARTS))
        columns = [pa.array(n), *_digests(values, at), *[pa.array(x.copy()) for x in parity.T], lists(held.view(np.int64), to, pa.int64())]
        return pa.StructArray.from_arrays(columns, ["n", "lo", "hi", *PARTS, "sketch"])

    return F.arrow_udf(sketch, _SKETCH_TYPE).asNondeterministic()


def _set_maker(words: int):
    def make(texts: pa.Array) -> pa.Array:
        values, at = shingle_sets(texts, words)
        return pa.StructArray.from_arrays([*_digests(values, at), lists(values.view(np.int64), at, pa.int64())], ["lo", "hi", "full"])

    return F.arrow_udf(make, "struct<lo:bigint,hi:bigint,full:array<bigint>>").asNondeterministic()


def connected(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node reachable over edges (a, b). Labels spread to neighbours and jump along labels, so rounds grow as a logarithm."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("_b")).select(F.col("a").alias("node"), F.least("a", "_b").alias("label")), "labels")
    hubs = materialize(heavy_keys(both, "b"), "hubs")
    while True:
        near = join_spread(both, labels.withColumnRenamed("node", "b"), "b", hubs, ["a"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_near"))
        met = materialize(labels.join(near, "node").select("node", F.col("label").alias("_old"), F.least("label", "_near").alias("_met")), "labels")
        jump = labels.select(F.col("node").alias("_met"), F.col("label").alias("_jump"))
        after = materialize(join_spread(met, jump, "_met", heavy_keys(met, "_met"), ["node"]).select("node", F.least("_met", "_jump").alias("label"), "_old"), "labels")
        changed = after.where("label <> _old").take(1)
        discard(labels, met)
        labels = after.drop("_old")
        if not changed:
            discard(both, hubs)
            return labels


def _odd_bits(threshold: float) -> int:
    """Odd bits of two parities beyond which the threshold is ruled out.

    At the threshold, at most 2 (1 - threshold) of the kept hashes are in one
    sketch only on average, when one set holds the other; the bound lies 4.5
    standard deviations above the bits that these leave odd.
    """
    d, keep = 2 * (1 - threshold) * SKETCH, 1 - 2 / PARITY
    spread = (4 * SKETCH * threshold * (1 - threshold) * keep ** (2 * d) + 2 * d * d / PARITY) ** 0.5
    return round(PARITY / 2 * (1 - keep**d) + 4.5 * spread)


def _frequent(values: DataFrame, limit: int) -> DataFrame:
    """v, _often: values (v) that more than SHORT and more than limit classes keep."""
    counts = values.groupBy("v").agg(F.count("*").alias("_c")).where((F.col("_c") > SHORT) & (F.col("_c") > limit))
    return counts.select("v", F.lit(True).alias("_often"))


def _runs(sketches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of two neighbouring values of each sketch (null: none), and their n + 1 offsets."""
    values, n = sketches.flatten().to_numpy().view(np.uint64), sketches.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    inner = np.ones(len(values), bool)
    inner[np.cumsum(n)[n > 0] - 1] = False
    runs = mix(mix(values[:-1], 301) + values[1:], 302)[inner[:-1]]
    return runs.view(np.int64), np.concatenate(([0], np.cumsum(np.maximum(n - 1, 0))))


def _frequent_runs(sketches: DataFrame, limit: int) -> np.ndarray:
    """Runs that more than SHORT and more than limit of these sketches have, in order; at most 2 SHARE (16 MB) come to the driver. Each batch is counted before its runs leave the task."""

    def count(batches):
        for batch in batches:
            runs, n = np.unique(_runs(batch.column(0))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(runs), pa.array(n)], ["v", "n"])

    counts = sketches.mapInArrow(count, "v bigint, n bigint").groupBy("v").agg(F.sum("n").alias("_c"))
    return np.sort(counts.where((F.col("_c") > SHORT) & (F.col("_c") > limit)).select("v").toArrow()["v"].to_numpy())


def _seldom_runs(often: np.ndarray):
    """The runs of a sketch that are not among these; none of a null sketch."""

    def seldom(sketches: pa.Array) -> pa.Array:
        runs, at = _runs(sketches)
        held = np.searchsorted(often, runs, "right") == np.searchsorted(often, runs)
        return lists(runs[held], np.concatenate(([0], np.cumsum(held)))[at], pa.int64())

    return F.arrow_udf(seldom, "array<bigint>").asNondeterministic()


def _listed(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of all classes, node, n, parity bits, _rare (values whose lists they are in); and the nodes of the crowd.

    _rare are up to USED of the values that are not frequent. A class that has
    too few of these adds the runs of two of its whole sketch that are not frequent,
    and is of the crowd if too few runs are left, too.
    """
    values = classes.select("node", F.explode(F.slice("sketch", 1, LISTED)).alias("v"))
    limit = (classes.agg(F.sum(F.least("n", F.lit(LISTED)))).first()[0] or 0) // SHARE
    seldom = F.array_sort(F.collect_list(F.when(F.col("_often").isNull(), F.col("v"))))
    kept = values.join(_frequent(values, limit), "v", "left").groupBy("node").agg(seldom.alias("_all"))
    few = (F.size("_all") < ENOUGH) | (F.size("_all") < RARE * F.least("n", F.lit(LISTED)))
    singles = kept.join(classes.select("node", "n", *PARTS, "sketch"), "node")
    singles = materialize(singles.select("node", "n", *PARTS, F.slice("_all", 1, USED).alias("_rare"), few.alias("_few"), F.when(few, F.col("sketch")).alias("_sketch")), "singles")
    often = _frequent_runs(singles.where("_few").select("_sketch"), limit)
    both = singles.withColumn("_runs", _seldom_runs(often)("_sketch"))
    crowd = F.col("_few") & (F.size("_runs") < SKETCH - 1 - COMMON)
    listed = materialize(both.select("node", "n", *PARTS, F.concat("_rare", "_runs").alias("_rare"), crowd.alias("_crowd")), "listed")
    discard(singles)
    return listed, listed.where("_crowd").select("node", "n", *PARTS)


def _shingle_counts(sets: DataFrame) -> np.ndarray:
    """Shingles of all sets by counter, summed in each task first; at most COUNTERS numbers come to the driver."""

    def run(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy() & (COUNTERS - 1), minlength=COUNTERS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["counter", "n"])

    found = sets.select("set").mapInArrow(run, "counter int, n bigint").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTERS, np.int32)
    out[found["counter"].to_numpy()] = np.minimum(found["n"].to_numpy(), np.iinfo(np.int32).max)
    return out


def _prefix_maker(counts: np.ndarray, share: tuple[int, int]):
    """The first shingles of a set in the order of their counters, as many as any other set at the threshold must share one of; those that are in no other set are left out. And the parity bits of the whole set."""

    def make(sets: pa.Array) -> pa.Array:
        values, n = sets.flatten().to_numpy(), sets.value_lengths().to_numpy()
        at = np.concatenate(([0], np.cumsum(n)))
        often = counts[values & (COUNTERS - 1)]
        order = np.lexsort((values, often, np.repeat(np.arange(len(n)), n)))
        place, prefix = np.arange(at[-1]) - np.repeat(at[:-1], n), n - -(-n.astype(np.int64) * share[0] // share[1]) + 1
        held = (place < np.repeat(prefix, n)) & (often[order] > 1)
        to = np.concatenate(([0], np.cumsum(held)))[at]
        bit = np.repeat(np.arange(len(n)) * FULL, n) + (values & (FULL - 1))
        parity = np.packbits(np.bincount(bit, minlength=len(n) * FULL) & 1).view(np.int64)
        full = lists(parity, np.arange(len(n) + 1) * (FULL // 64), pa.int64())
        return pa.StructArray.from_arrays([lists(values[order][held], to, pa.int64()), lists(place[held], to, pa.int64()), full], ["v", "at", "full"])

    return F.arrow_udf(make, "struct<v:array<bigint>,at:array<bigint>,full:array<bigint>>").asNondeterministic()


def _crowded(crowd: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """v, node, n, parity bits, at, full: lists of the rarest shingles of the crowd's full sets, with the place of v in its set's order.

    Any order that is the same for all sets is exact, so counters of a fixed
    number decide it, and only the prefixes leave their tasks. Shingles whose
    counter is 1 are in one set only: they come first and make no list.
    """
    counts = _shingle_counts(sets)
    placed = sets.select("node", _prefix_maker(counts, share)("set").alias("_p")).select("node", F.col("_p.full").alias("full"), F.explode(F.arrays_zip("_p.v", "_p.at")).alias("_e"))
    return materialize(placed.join(crowd, "node").select((-1 - F.col("_e.v")).alias("v"), "node", "n", *PARTS, F.col("_e.at").alias("at"), "full"), "crowded")


def _estimated(pairs: DataFrame, classes: DataFrame, threshold: float, size: int) -> DataFrame:
    """Pairs (a, b) whose union sketch doesn't rule the threshold out, with the estimate, written. pairs must be materialized."""
    nodes = materialize(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "nodes")
    sketches = materialize(classes.join(sent_if_few(nodes), "node").select("node", "sketch"), "candidates")
    side = lambda x: sketches.select(F.col("node").alias(x), F.col("sketch").alias(f"_{x}"))
    union = F.slice(F.array_sort(F.array_union("_a", "_b")), 1, size)
    with_union = join_spread(pairs, side("a"), "a", heavy_keys(pairs, "a"), ["b"]).join(side("b"), "b").withColumn("_u", union)
    found = F.size(F.array_intersect("_u", F.array_intersect("_a", "_b"))) / F.size("_u")
    least = threshold - MARGIN * (threshold * (1 - threshold) / size) ** 0.5
    out = materialize(with_union.select("a", "b", found.alias("estimate")).where(F.col("estimate") >= least), "estimated")
    discard(nodes, sketches)
    return out


class _Sets:
    """Full sets of classes, made from their texts once, however many pairs need them."""

    def __init__(self, classes: DataFrame, docs: DataFrame, words: int) -> None:
        self.classes, self.docs, self.words, self.made = classes, docs, words, None

    def of(self, nodes: DataFrame) -> DataFrame:
        """node, set of these nodes, and of those that were asked for before."""
        nodes = nodes if self.made is None else nodes.join(self.made.select("node"), "node", "left_anti")
        needed = materialize(self.classes.join(nodes, "node").select("node", "key", "lo", "hi"), "needed")
        found = self.docs.join(sent_if_few(needed), "key").select("node", "lo", "hi", _set_maker(self.words)("text").alias("_s"))
        sets = materialize(found.where("_s.lo = lo and _s.hi = hi").select("node", F.col("_s.full").alias("set")).dropDuplicates(["node"]), "sets")
        discard(needed)
        self.made = sets if self.made is None else self.made.unionByName(sets)
        return self.made

    def linked(self, pairs: DataFrame, share: tuple[int, int]) -> DataFrame:
        """Pairs (a, b; materialized) whose full sets reach the threshold."""
        sets = self.of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        side = lambda x: sets.select(F.col("node").alias(x), F.col("set").alias(f"_{x}"))
        both = F.size(F.array_intersect("_a", "_b"))
        met = join_spread(pairs, side("a"), "a", heavy_keys(pairs, "a"), ["b"])
        met = join_spread(met, side("b"), "b", heavy_keys(pairs, "b"), ["a"])
        return materialize(met.where(both * share[1] >= share[0] * (F.size("_a") + F.size("_b") - both)).select("a", "b"), "verified")

    def discard(self) -> None:
        if self.made is not None:
            discard(self.made)


def near_duplicates(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", words: int = 5, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """One row a row of docs: doc_id, n_shingles, component_id, kept.

    Two texts are linked if share[1] * |A and B| >= share[0] * |A or B| over
    their sets of word shingles (A-Z lower-cased; words are runs of other
    characters than ASCII white space). component_id is the smallest id in
    reach. Texts without words, null ones included, are linked with nothing.
    Rows of equal id each keep their row; a component without any id has a null
    component_id, and its rows are kept. Further columns of docs are ignored.
    A link at the very threshold is missed with a probability of about 1e-5 (of
    16 listed values none is common: 1e-11; crowd and outside 2e-7; parity bits 4.5
    and estimate 5 standard deviations: 3e-6 each); more similar texts far less often.
    """
    ready_for_python(docs.sparkSession)
    threshold = share[0] / share[1]
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id), F.col(text)).alias("key"))
    meta = materialize(docs.select("id", "key", _sketcher(words, SKETCH)("text").alias("s")).select("id", "key", "s.*"), "sketches")
    classes = meta.where("n > 0").groupBy("lo", "hi", "n").agg(F.min(F.struct(F.col("id").isNull().alias("_none"), "id", "key")).alias("_first"), F.count("*").alias("rows"), *[F.any_value(c).alias(c) for c in (*PARTS, "sketch")])
    classes = classes.select("lo", "hi", "n", "rows", *PARTS, "sketch", F.col("_first.id").alias("least_id"), F.col("_first.key").alias("key"), F.monotonically_increasing_id().alias("node"))
    classes = materialize(classes, "classes")
    sets = _Sets(classes, docs, words)
    listed, crowd = _listed(classes)
    rare = listed.select("node", "n", *PARTS, F.col("_crowd").alias("crowd"), F.lit(None).cast("bigint").alias("at"), F.lit(None).cast("array<bigint>").alias("full"), F.explode("_rare").alias("v"))
    crowded = _crowded(crowd, sets.of(crowd.select("node")), share)
    lists_of = materialize(rare.unionByName(crowded.withColumn("crowd", F.lit(True))), "lists")
    discard(listed, crowded)
    most = _odd_bits(threshold)

    def alike(x, y) -> Column:
        """Sizes and, in lists of the crowd, places and bits of the full sets allow the threshold, and so do the sketches' parity bits; sketches of small sets are the sets, so that their bits decide for sure."""
        larger = F.greatest(x("n"), y("n"))
        bits = sum((F.bit_count(x(c).bitwiseXOR(y(c))) for c in PARTS[1:]), F.bit_count(x(PARTS[0]).bitwiseXOR(y(PARTS[0]))))
        small = F.when(larger <= SKETCH, F.floor((1 / threshold - 1) * larger + 1e-9)).otherwise(most)
        common = F.least(x("n") - F.coalesce(x("at"), F.lit(0)), y("n") - F.coalesce(y("at"), F.lit(0)))
        apart = sum(F.bit_count(F.get(x("full"), F.lit(i)).bitwiseXOR(F.get(y("full"), F.lit(i)))) for i in range(FULL // 64))
        differ = F.coalesce(apart, F.lit(0)) * (share[1] + share[0]) <= (x("n") + y("n")) * (share[1] - share[0])
        elsewhere = x("crowd") & y("crowd") & x("at").isNull()  # two of the crowd meet through their full sets, where more is known of them
        return ~elsewhere & (common * share[1] >= (x("n") + y("n") - common) * share[0]) & (bits <= small) & differ

    # a list of the crowd is led by the member with the fewest rarer shingles: the nearest to an original among its copies
    leaders = lists_of.groupBy("v").agg(F.min(F.struct("at", "node", "n", *PARTS, "full", "crowd")).alias("_l"), F.count("*").alias("_c")).where("_c > 1")
    near = alike(F.col, lambda c: F.col(f"_l.{c}"))
    often = heavy_keys(lists_of, "v")
    led = join_spread(lists_of, leaders, "v", often, ["node"]).where((F.col("node") != F.col("_l.node")) & near)
    led = materialize(led.select(F.col("_l.node").alias("a"), F.col("node").alias("b")).distinct(), "led")
    estimated = _estimated(led, classes, threshold, SKETCH)
    first = sets.linked(estimated.select("a", "b"), share)
    labels = connected(first)
    one = materialize(classes.select("node").join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("c")), "components")
    discard(led, estimated, first, labels)

    placed = lists_of.join(one, "node")
    parts = placed.groupBy("v", "c").agg(F.count("*").alias("_n"))
    mixed = parts.groupBy("v").agg(F.count("*").alias("_parts"), F.sum("_n").alias("_all"), F.max_by("c", F.struct("_n", "c")).alias("_main")).where("_parts > 1").select("v", "_main", "_all")
    mixed = materialize(mixed, "mixed")
    placed = materialize(join_spread(lists_of, mixed, "v", often, ["node"]).join(one, "node"), "mixed-lists")
    discard(mixed, lists_of)
    # members of a long list are dealt to blocks, and each member that is not of the main component meets all of them
    blocks = F.floor(F.col("_all") / spread_limit(placed.count()))
    side = lambda x: [*[F.col(c).alias(f"_{x}{c}") for c in ("node", "n", *PARTS, "at", "full", "crowd", "c")]]
    x = placed.where("c <> _main").select("v", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks)).alias("_block"), *side("x"))
    y = placed.select("v", F.pmod(F.xxhash64("node"), blocks + 1).alias("_block"), *side("y"), "_main")
    near = alike(lambda c: F.col(f"_x{c}"), lambda c: F.col(f"_y{c}"))
    crossed = x.join(y, ["v", "_block"]).where((F.col("_xc") != F.col("_yc")) & ((F.col("_yc") == F.col("_main")) | (F.col("_xnode") < F.col("_ynode"))) & near)
    crossed = materialize(crossed.select(F.least("_xnode", "_ynode").alias("a"), F.greatest("_xnode", "_ynode").alias("b")).distinct(), "crossed")
    estimated = _estimated(crossed, classes, threshold, SKETCH)
    second = sets.linked(estimated.select("a", "b"), share)
    label = lambda x: one.select(F.col("node").alias(x), F.col("c").alias(f"_{x}"))
    labels = connected(second.join(label("a"), "a").join(label("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).where("a <> b"))
    final = one.join(labels.select(F.col("node").alias("c"), F.col("label").alias("_l")), "c", "left").select("node", F.coalesce("_l", "c").alias("c"))
    final = materialize(classes.select("node", "lo", "hi", "n", "rows", "least_id").join(final, "node"), "final")
    sets.discard()
    discard(placed, crossed, estimated, second, labels, one, classes)
    # classes that are alone and have one row are their own component; others are looked up
    joined = final.groupBy("c").agg(F.min("least_id").alias("component_id"), F.sum("rows").alias("_rows")).where("_rows > 1").select("c", "component_id")
    found = join_spread(final, joined, "c", heavy_keys(final, "c"), ["node"])
    found = materialize(found.select("lo", "hi", "n", "rows", "component_id", F.lit(True).alias("_found")), "found")
    discard(final)
    # at most SPREAD classes have more rows than the limit
    limit, rows = spread_limit(meta.count()), meta.select("id", "n", "lo", "hi")
    copied, others = F.broadcast(found.where(F.col("rows") > limit)), found.where(F.col("rows") <= limit)
    key = ["lo", "hi", "n"]
    rows = rows.join(copied, key).unionByName(rows.join(copied, key, "left_anti").join(sent_if_few(others), key, "left"))
    component = F.when(F.col("_found"), F.col("component_id")).otherwise(F.col("id"))
    return rows.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def query(spark, sf_dir):
    """op9: components over 2-word shingles. An empty table gives an empty result."""
    return near_duplicates(read(spark, sf_dir, "documents"), words=2)
