"""
Near-duplicate documents by SetSketch registers, confirmed on whole shingle sets.

Every register holds an exponentially spaced, truncated minimum of hashes: the number of the
interval between powers of `BASE` that the minimum falls into, held between 0 and `TOP`. Registers
of a union are the element-wise maxima. Two sets agree in a register with a probability close to
their Jaccard similarity (Ertl, "SetSketch: filling the gap between MinHash and HyperLogLog",
2021).

1. One scan gives each document its set's size, digest and registers. Documents of equal sets
   are one class, known by its smallest doc_id; only classes are compared.
2. Bands of registers put classes into buckets. In a bucket the joint likelihood of sizes and
   register orders tells which pairs can reach the threshold; what is passed on is a spanning
   forest of them, at most one link a member. Large buckets are dealt to tiles.
3. The forest's components hold every possible link between them. In each component all pairs are
   compared by the exact intersections of their full sets, again in tiles that give forests.
4. The components of the confirmed links are the result.

A pair at similarity 0.75 meets in one of 32 bands of 4 registers with all but 5e-6 probability
and passes the likelihood test with all but about 1e-7; both fall fast above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.graph import components, tile_roots
from rollcall.llm.tiles import meet
from rollcall.llm.words import shingle_sets, stream, word_slices
from rollcall.session import materialise

REGISTERS, BAND = 128, 4
BASE, RATE, TOP = 1.001, 20.0, 65535
PERCENT = 75
# Pairs whose likeliest similarity is below this are not compared in full: 5 standard errors
# of 128 registers below the threshold.
FLOOR = 0.55
# What a block holds; a tile holds two blocks: members of a bucket, members and shingles of a
# cluster whose full sets are compared.
BUCKET_MEMBERS = 512
BLOCK_MEMBERS, BLOCK_SHINGLES = 128, 100_000

_FACTORS = stream(11, REGISTERS) | np.uint64(1)


def registers(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """uint16 registers, a row per set, of non-empty sets given one behind the other."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    lowest = np.empty((len(sizes), REGISTERS), np.float64)
    for j, factor in enumerate(_FACTORS):
        lowest[:, j] = np.minimum.reduceat(codes * factor, starts)
    level = -np.log1p(-(lowest + 0.5) / 2.0 ** 64) / RATE
    return np.clip(np.floor(1 - np.log(level) / np.log(BASE)), 0, TOP).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def _slope(j, above, below, equal, n_a, n_b):
    """Derivative of the joint log-likelihood at similarity j; it falls as j grows."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    step = (BASE - 1) / BASE

    def chance(x):
        return -np.log1p(-x * step) / np.log(BASE)

    def steepness(x):
        return step / (np.log(BASE) * (1 - x * step))

    x, y = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
    rest = np.maximum(1 - chance(x) - chance(y), 1e-12)
    return -above * v * steepness(x) / chance(x) - below * u * steepness(y) / chance(y) \
        + equal * (v * steepness(x) + u * steepness(y)) / rest


def likeliest(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> float:
    """The similarity that makes the registers of two sets of known sizes likeliest."""
    above, below = int((a > b).sum()), int((a < b).sum())
    low, high = 0.0, min(n_a / n_b, n_b / n_a)
    for _ in range(50):
        middle = (low + high) / 2
        up = _slope(middle, above, below, len(a) - above - below, n_a, n_b) > 0
        low, high = (middle, high) if up else (low, middle)
    return low


def possible_pairs(regs: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) whose sizes allow the threshold and whose likeliest similarity is not
    below FLOOR."""
    i, j = np.triu_indices(len(sizes), 1)
    small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
    close = 100 * small >= PERCENT * large
    i, j = i[close], j[close]
    found = []
    for at in range(0, len(i), 8192):
        p, q = i[at:at + 8192], j[at:at + 8192]
        above = (regs[p] > regs[q]).sum(1)
        below = (regs[p] < regs[q]).sum(1)
        found.append(_slope(FLOOR, above, below, REGISTERS - above - below,
                            sizes[p].astype(float), sizes[q].astype(float)) >= 0)
    keep = np.concatenate(found) if found else np.zeros(0, bool)
    return i[keep], j[keep]


def linked_pairs(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """
    Index pairs (i < j) of sets with 100 * intersection >= 75 * union.

    Intersections are products of 0/1 matrices, a range of the tile's shingles at a time.
    """
    sizes = np.array([len(s) for s in sets])
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = times[code] > 1
    number = np.cumsum(times > 1) - 1
    code, owner = number[code[shared]], owner[shared]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    both = np.zeros((len(sets), len(sets)), np.float64)
    width = 4096
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, [low, low + width])
        table = np.zeros((len(sets), min(width, int(code[-1]) + 1 - low)), np.float32)
        table[owner[a:b], code[a:b] - low] = 1
        both += table @ table.T
    union = sizes[:, None] + sizes[None, :] - both
    return np.nonzero(np.triu(100 * both >= PERCENT * union, 1))


def _digest(codes: np.ndarray) -> np.ndarray:
    return np.frombuffer(hashlib.blake2b(codes.tobytes(), digest_size=16).digest(), np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words in word_slices(batch.column("text")):
            codes, sizes = shingle_sets(words)
            full = np.flatnonzero(sizes)
            regs = registers(codes, sizes[full]) if len(full) else None
            place = iter(range(len(full)))
            digests = np.zeros((len(sizes), 2), np.int64)
            packed: list[bytes | None] = [None] * len(sizes)
            ends = np.cumsum(sizes)
            for t in full:
                digests[t] = _digest(codes[ends[t] - sizes[t]:ends[t]])
                packed[t] = regs[next(place)].tobytes()
            yield pa.record_batch({
                **{c: batch.column(c).slice(words.row, len(words))
                   for c in ("doc_id", "text_hash")},
                "n_shingles": pa.array(sizes, pa.int64()), "d1": pa.array(digests[:, 0]),
                "d2": pa.array(digests[:, 1]), "registers": pa.array(packed, pa.binary())})


SKETCH = "doc_id long, text_hash long, n_shingles long, d1 long, d2 long, registers binary"


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, d1, d2, registers) of every row; the digest (d1, d2) is that
    of the shingle set, registers are null for an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64("text").alias("text_hash")) \
        .mapInArrow(_sketch, SKETCH)


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words in word_slices(batch.column("text")):
            codes, sizes = shingle_sets(words)
            ends = np.cumsum(sizes)
            sets = [codes[e - n:e] for e, n in zip(ends, sizes)]
            digests = np.array([_digest(s) for s in sets]).reshape(-1, 2)
            yield pa.record_batch({
                **{c: batch.column(c).slice(words.row, len(words))
                   for c in ("root", "blocks", "rep", "d1", "d2")},
                "e1": pa.array(digests[:, 0]), "e2": pa.array(digests[:, 1]),
                "codes": pa.array([s.tobytes() for s in sets], pa.binary())})


def _members(batch: pa.RecordBatch) -> Iterator[dict[str, pa.Array]]:
    """The members of each row's list of structs, by field."""
    lists = batch.column("members")
    flat = lists.flatten()
    fields = {flat.type[k].name: flat.field(k) for k in range(flat.type.num_fields)}
    at = 0
    for n in lists.value_lengths().to_pylist():
        yield {k: v.slice(at, n) for k, v in fields.items()}
        at += n


def _forest(reps: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple:
    roots = tile_roots(len(reps), left, right)
    own = np.flatnonzero(roots != np.arange(len(reps)))
    return reps[own], reps[roots[own]]


def _edges(pairs: list[tuple]) -> pa.RecordBatch:
    a, b = (np.concatenate([p[k] for p in pairs] or [np.zeros(0, np.int64)]) for k in (0, 1))
    return pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for m in _members(batch):
            regs = np.frombuffer(b"".join(m["registers"].to_pylist()), np.uint16)
            out.append(_forest(m["rep"].to_numpy(), *possible_pairs(
                regs.reshape(-1, REGISTERS), m["n_shingles"].to_numpy())))
        yield _edges(out)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for m in _members(batch):
            sets = [np.frombuffer(x, np.uint64) for x in m["codes"].to_pylist()]
            out.append(_forest(m["rep"].to_numpy(), *linked_pairs(sets)))
        yield _edges(out)


def _buckets(reps: DataFrame) -> DataFrame:
    """Distinct lists of classes that share a band: one row for each tile of a bucket."""
    bands = REGISTERS // BAND
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.xxhash64(
        b, F.substring(F.col("registers"), b * (2 * BAND) + 1, F.lit(2 * BAND))))
    banded = reps.select(F.explode(keys).alias("key"), "rep")
    full = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = meet(banded.join(full, "key"), "rep", F.ceil(F.col("n") / BUCKET_MEMBERS))
    return dealt.groupBy("key", "i", "j").agg(F.sort_array(F.collect_set("rep")).alias("reps")) \
        .where("size(reps) > 1").select("reps").distinct() \
        .select(F.xxhash64("reps").alias("tile"), "reps")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """
    (doc_id, n_shingles, component_id, kept) for every row of docs (doc_id, text, ...).

    Words are lower-cased in A-Z and cut at ASCII white space; a set holds the distinct runs of
    five words, the whole sequence if there are fewer, nothing without words or text. Documents
    are linked at 100 * intersection >= 75 * union; component_id is the smallest doc_id that
    links reach. An empty set is linked with nothing, also not with other empty ones. Rows that
    repeat a doc_id are judged each by its own text. A row without doc_id is linked with
    nothing: its component_id is null and it is kept. Other columns are not looked at; an
    empty table gives an empty one.
    """
    return _judged(docs).select("doc_id", "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame) -> DataFrame:
    """near_duplicates with d1, d2 and text_hash."""
    sketched = materialise(sketches(docs), "sketches")
    classes = sketched.where("n_shingles > 0 and doc_id is not null") \
        .groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    classes = materialise(classes, "classes")
    heads = sketched.where("n_shingles > 0").join(
        classes.select("d1", "d2", F.col("rep").alias("doc_id")), ["d1", "d2", "doc_id"]) \
        .select(F.col("doc_id").alias("rep"), "n_shingles", "registers", "d1", "d2") \
        .dropDuplicates(["rep", "d1", "d2"])
    tiles = materialise(_buckets(heads), "buckets")
    possible = tiles.select("tile", F.explode("reps").alias("rep")).join(
        heads.drop("d1", "d2"), "rep") \
        .groupBy("tile").agg(F.collect_list(F.struct("rep", "n_shingles", "registers"))
                             .alias("members")) \
        .select("members").mapInArrow(_possible, "a long, b long")
    clusters = components(possible)
    roots = components(_confirmed(docs, heads, clusters))
    found = classes.join(roots.select(F.col("vertex").alias("rep"), "root"), "rep", "left") \
        .select("d1", "d2", F.coalesce("root", "rep").alias("component_id"))
    whole = F.col("n_shingles") > 0
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")) \
        .when(whole, F.col("component_id")).otherwise(F.col("doc_id"))
    return sketched.drop("registers").join(found, ["d1", "d2"], "left") \
        .select("doc_id", "n_shingles", component.alias("component_id"), "d1", "d2",
                "text_hash") \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _confirmed(docs: DataFrame, heads: DataFrame, clusters: DataFrame) -> DataFrame:
    """A forest of the links between the classes of each cluster, from their full sets."""
    members = clusters.join(heads.drop("registers"), F.col("vertex") == F.col("rep")) \
        .select("root", "rep", "n_shingles", "d1", "d2")
    members = materialise(members, "clusters")
    blocks = members.groupBy("root").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS),
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    # The same plan at every size: both sides are dealt by id. Repeated rows give one text.
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text",
                        F.xxhash64("text").alias("_hash")).repartition("rep") \
        .dropDuplicates(["rep", "_hash"]).drop("_hash")
    sets = members.join(blocks, "root").drop("n_shingles").hint("merge").join(texts, "rep") \
        .select("root", "blocks", "rep", "d1", "d2", "text") \
        .mapInArrow(_full_sets, "root long, blocks int, rep long, d1 long, d2 long, "
                                "e1 long, e2 long, codes binary") \
        .where("d1 = e1 and d2 = e2").select("root", "blocks", "rep", "codes")
    return meet(sets, "rep", F.col("blocks")).groupBy("root", "i", "j") \
        .agg(F.collect_list(F.struct("rep", "codes")).alias("members")) \
        .select("members").mapInArrow(_linked, "a long, b long")


def deduplicated(docs: DataFrame) -> DataFrame:
    """
    The rows of docs, all columns, of which one document of each group stays: the one with the
    smallest doc_id, once. Of rows that share a doc_id each different set of shingles is judged by
    itself, and one row of each that is kept stays. Rows without doc_id stay as they are.
    """
    kept = _judged(docs).where("kept and doc_id is not null").groupBy("doc_id", "d1", "d2") \
        .agg(F.min("text_hash").alias("_hash")) \
        .select(F.col("doc_id").alias("_kept"), F.col("_hash").alias("_kept_hash")).distinct()
    rows = docs.where("doc_id is not null").withColumn("_hash", F.xxhash64("text"))
    chosen = rows.join(kept, (F.col("doc_id").cast("long") == F.col("_kept"))
                       & (F.col("_hash") == F.col("_kept_hash")), "left_semi")
    return chosen.dropDuplicates(["doc_id", "_hash"]).drop("_hash") \
        .unionByName(docs.where("doc_id is null"))
