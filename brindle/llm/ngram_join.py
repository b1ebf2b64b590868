"""Similarity self-join of texts by the Jaccard coefficient of their word n-grams, with a MinHash LSH forest.

Each text is the set of its word n-grams (five words; a text of fewer words, but not none, is one n-gram). Texts with
equal sets form a class, and only classes are compared. A class's MinHash signature is cut into labels, one per tree;
the labels of a tree, sorted, are a prefix trie, and classes below a node of a trie are candidates.

The search goes up the tries, from the longest prefixes to shorter ones. What is linked so far is a component, within
which all sets are compared later on, and classes that reach the same one over two links are known to be in one. So a
node is open only if it holds several of these; the classes of other nodes are not compared again, nor are two of one
component. A class's prefix is therefore shortened only
as far as shorter ones bring it together with something new: a group of near copies mostly ends at the longest prefix,
borderline pairs go on. The last prefix length is the longest one with which even a pair at the threshold is found with
the target's chance. It depends on the parameters alone; a class stops earlier only where all that it still
meets is in its own component, so no group loosens the search of another.

Candidates are not listed as pairs. Classes of an open node are compared block by block, the signatures of similar ones
link them to components, and within a component the sets themselves are compared, again block by block, all with all.
What leaves a block are counts and a spanning forest, so no output grows with the square of a group.

Texts without words (NULL too) are alike to none and stay classes of their own. Repeated rows are copies. Extra columns
are ignored, or carried along by `keep_one`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.components import components
from brindle.llm.joining import packed, with_findings, without_findings
from brindle.llm.words import mixed, slices, split, windows
from brindle.session import materialize, scratch_of_its_own

WORDS = 5
THRESHOLD = 0.8
TREES, DEPTH = 24, 6  # tries, and values of a label
TARGET = 0.99999  # recall of a pair at the threshold; those above it are missed less often
ESTIMATE = 64  # signature values that are compared before the sets are
MARGIN = 0.25  # how far below the threshold an estimate may be; five standard deviations
BLOCK = 512  # classes of a block
BLOCK_GRAMS = 200_000  # n-grams of a block
HELD = 500  # groups whose results are held before they are given on
RUN = 1 << 16  # n-grams whose MinHash values are worked out at a time

_RNG = np.random.default_rng(20)
_FACTOR = _RNG.integers(1 << 31, 1 << 32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_ADDEND = _RNG.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32)


def gram_sets(texts: list[bytes | None], size: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    words = split(texts)
    hashes, at = windows(words, size)
    bounds = np.searchsorted(at, words.first)
    sets = []
    for t, n in enumerate(words.counts):
        if 0 < n < size:
            whole = np.uint64(n)
            for h in words.of(t):
                whole = mixed(np.array([whole ^ h]))[0]
            sets.append(np.array([whole], dtype=np.uint64))
        else:
            sets.append(np.unique(hashes[bounds[t] : bounds[t + 1]]))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, 16 bits each, as rows of TREES * DEPTH; empty sets have a row of zeros."""
    out = np.zeros((len(sets), TREES * DEPTH), dtype=np.uint16)
    some = [i for i, s in enumerate(sets) if len(s)]
    at = 0
    while at < len(some):
        stop, total = at, 0
        while stop < len(some) and (stop == at or total + len(sets[some[stop]]) <= RUN):
            total += len(sets[some[stop]])
            stop += 1
        part = [sets[i] for i in some[at:stop]]
        values = (np.concatenate(part) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0] + [len(p) for p in part])[:-1]
        room = np.empty_like(values)
        least = np.empty((TREES * DEPTH, len(part)), dtype=np.uint32)
        for k in range(TREES * DEPTH):
            np.multiply(values, _FACTOR[k], out=room)
            np.add(room, _ADDEND[k], out=room)
            room ^= room >> np.uint32(15)
            np.minimum.reduceat(room, starts, out=least[k])
        out[some[at:stop]] = (mixed(least.T.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)
        at = stop
    return out


def _signed_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for rows, texts in slices(batches, "text"):
        sets = gram_sets(texts, size)
        marks = signatures(sets)
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        signs = [m.tobytes() if len(s) else None for m, s in zip(marks, sets, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id"), rows.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(digests, pa.binary()), pa.array(signs, pa.binary()),
            ],
            names=["doc_id", "text_key", "n_grams", "digest", "sign"],
        )


def _signed(docs: DataFrame, size: int) -> DataFrame:
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    signed = rows.mapInArrow(
        lambda batches: _signed_rows(batches, size),
        f"doc_id {id_type}, text_key bigint, n_grams bigint, digest binary, sign binary",
    )
    return materialize(signed.withColumn("row", F.monotonically_increasing_id()), "signed")


def _classes(signed: DataFrame) -> DataFrame:
    """One row per set of n-grams: node (a row that has it), its doc_id and text_key, class_id (least id), sizes, sign."""
    grouped = signed.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min(F.struct("row", "doc_id", "text_key")).alias("one"), F.min("doc_id").alias("class_id"),
        F.count(F.lit(1)).alias("class_size"), F.max("n_grams").alias("n_grams"), F.max("sign").alias("sign"),
    )
    return materialize(grouped.select("digest", "one.*", "class_id", "class_size", "n_grams", "sign").withColumnRenamed("row", "node"), "classes")


def recall(similarity: np.ndarray | float, depth: int, trees: int = TREES):
    """The chance that two sets share a prefix of `depth` values in one of the trees."""
    return 1 - (1 - np.asarray(similarity, dtype=float) ** depth) ** trees


def _spread(df: DataFrame, weight: Column, member: str) -> DataFrame:
    """Each row once per pair of blocks that it takes part in: `block`, `low` and `high`. `weight` is the number of blocks."""
    block = F.pmod(F.xxhash64(member), weight)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), weight - 1))
    pairs = df.withColumn("block", block).withColumn("other", other)
    return pairs.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other")


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[dict[str, list]]:
    """Columns of each run of rows with equal `by`, over batch borders."""
    held: dict[str, list] | None = None
    key = None
    for batch in batches:
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        keys = list(zip(*(columns[n] for n in by), strict=True))
        for value, run in groupby(range(len(keys)), key=keys.__getitem__):
            picked = list(run)
            part = {n: c[picked[0] : picked[-1] + 1] for n, c in columns.items()}
            if held is not None and value == key:
                for n in held:
                    held[n] += part[n]
            else:
                if held is not None:
                    yield held
                held, key = part, value
    if held is not None:
        yield held


def _roots(alike: np.ndarray) -> np.ndarray:
    """The least member linked to each member, over any number of links; `alike` is a symmetric boolean matrix."""
    root = np.arange(len(alike))
    linked = alike | np.eye(len(alike), dtype=bool)
    while True:
        low = np.where(linked, root[None, :], len(root)).min(1)
        low = np.minimum(root, low[low])
        if (low == root).all():
            return root
        root = low


def _equal_values(sign: np.ndarray) -> np.ndarray:
    """How many values each two signatures share."""
    if len(sign) <= 32:
        return (sign[:, None, :] == sign[None, :, :]).sum(2)
    equal = np.zeros((len(sign), len(sign)), dtype=np.uint16)
    for column in sign.T:
        equal += column[:, None] == column[None, :]
    return equal


def _table(parts: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names=names)


def _by_estimate(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Edges to the root of each trie node, between classes of different components."""
    names, parts = ["node", "root"], []
    least = threshold - MARGIN
    for g in _groups(batches, ["cell", "low", "high"]):
        node, first = np.unique(np.array(g["node"]), return_index=True)
        comp = np.array(g["comp"])[first]
        if (comp == comp[0]).all():
            continue
        sign = np.frombuffer(b"".join(g["sign"][i] for i in first), dtype=np.uint16).reshape(len(first), -1)
        equal = _equal_values(sign)
        alike = (equal >= least * sign.shape[1]) & (comp[:, None] != comp[None, :])
        if g["low"][0] != g["high"][0]:
            block = np.array(g["block"])[first]
            alike &= block[:, None] != block[None, :]
        if not alike.any():
            continue
        root = _roots(alike)
        some = root != np.arange(len(node))
        parts.append((node[some], node[root[some]]))
        if len(parts) >= HELD:
            yield _table(parts, names)
            parts = []
    if parts:
        yield _table(parts, names)


def _cell(label: Column, depth: int) -> Column:
    """The trie node of a label (its tree's number first) at a depth."""
    return F.xxhash64(F.substring(label, 1, 2 + 2 * depth))


def _tries(classes: DataFrame, depth: int) -> DataFrame:
    """node and label of each class in each tree, where another class shares `depth` values with it: the others meet none."""
    wide = 2 * DEPTH
    labels = F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.concat(F.unhex(F.lpad(F.hex(t), 4, "0")), F.substring(F.col("sign"), t * wide + 1, F.lit(wide))),
    )
    leaves = classes.select("node", F.explode(labels).alias("label")).withColumn("cell", _cell(F.col("label"), depth))
    shared = leaves.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("cell")
    return materialize(leaves.join(materialize(shared, "shared"), "cell").drop("cell"), "tries")


def _open_nodes(tries: DataFrame, comps: DataFrame | None, depth: int) -> DataFrame:
    """The classes of trie nodes that hold several components: cell, n (classes of the node), node, comp."""
    own = tries.select("node", _cell(F.col("label"), depth).alias("cell"))
    if comps is None:
        own = own.withColumn("comp", F.col("node"))
    else:
        own = own.join(comps, "node", "left").select("node", "cell", F.coalesce("root", "node").alias("comp"))
    several = own.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    several = materialize(several.where("low != high").select("cell", "n"), f"open{depth}")
    return materialize(own.join(several, "cell"), f"members{depth}")


def _round(classes: DataFrame, members: DataFrame, depth: int, threshold: float) -> DataFrame:
    """Links by estimate between components that meet in an open node."""
    short = classes.select("node", F.substring("sign", 1, 2 * ESTIMATE).alias("sign"))
    spread = _spread(members.join(short, "node"), F.ceil(F.col("n") / BLOCK), "node")
    by = ["cell", "low", "high"]
    compared = (
        spread.select(*by, "block", "node", "comp", "sign").repartition(*by).sortWithinPartitions(*by)
        .mapInArrow(lambda batches: _by_estimate(batches, threshold), "node bigint, root bigint")
    )
    return materialize(compared.distinct(), f"links{depth}")


def forest_depth(threshold: float = THRESHOLD, target: float = TARGET) -> int:
    """The longest prefix with which a pair at the threshold is found with the target's chance; 1 if there is none."""
    return next((d for d in range(DEPTH, 1, -1) if recall(threshold, d) >= target), 1)


def _joined(links: DataFrame, depth: int) -> DataFrame:
    """The least node that each linked node reaches over two links: nodes with the same one are in one component."""
    least = materialize(links.groupBy("node").agg(F.min("root").alias("root")), f"joined{depth}")
    further = least.select(F.col("node").alias("via"), F.col("root").alias("end"))
    return least.join(further, F.col("root") == F.col("via"), "left").select("node", F.coalesce("end", "root").alias("root"))


def rounds(classes: DataFrame, threshold: float = THRESHOLD, target: float = TARGET) -> Iterator[tuple[int, DataFrame, DataFrame]]:
    """The search, longest prefixes first: the prefix length, the classes of its open nodes, and all links up to there."""
    last = forest_depth(threshold, target)
    tries, comps, links = _tries(classes, last), None, None
    for depth in range(DEPTH, last - 1, -1):
        members = _open_nodes(tries, comps, depth)
        found = _round(classes, members, depth, threshold)
        links = found if links is None else links.unionByName(found)
        yield depth, members, links
        if depth > last:
            comps = _joined(links, depth)


def forest_links(classes: DataFrame, threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """Links by estimate that join all candidates to components."""
    *_, (_, _, links) = rounds(classes, threshold, target)
    return links


def search_depths(docs: DataFrame, size: int = WORDS, threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """How far each class's prefix was shortened: class_id, depth (of the last open node with the class in it).

    NULL for a class that shares no prefix with another.
    """
    classes = _classes(_signed(docs, size))
    met = None
    for depth, members, _ in rounds(classes, threshold, target):
        here = members.select("node", F.lit(depth).alias("depth"))
        met = here if met is None else met.unionByName(here)
    ends = met.groupBy("node").agg(F.min("depth").alias("depth"))
    return classes.select("node", "class_id").join(ends, "node", "left").select("class_id", "depth")


def jaccard_at_least(sets: list[np.ndarray], threshold: Fraction) -> np.ndarray:
    """Whether the Jaccard coefficient of each two sets reaches the threshold, worked out exactly."""
    m = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    both = np.zeros((m, m), dtype=np.int64)
    if m <= 6:
        for i in range(m):
            for j in range(i + 1, m):
                both[i, j] = both[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    else:
        values, code = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(m), size)
        often = np.bincount(code, minlength=len(values)) > 1
        column = np.cumsum(often) - 1
        keep = often[code]
        code, owner = column[code[keep]], owner[keep]
        order = np.argsort(code, kind="stable")
        code, owner = code[order], owner[order]
        step = 2048
        for at in range(0, int(often.sum()), step):
            lo, hi = np.searchsorted(code, [at, at + step])
            part = np.zeros((m, step), dtype=np.float32)
            part[owner[lo:hi], code[lo:hi] - at] = 1
            both += (part @ part.T).astype(np.int64)
    union = size[:, None] + size[None, :] - both
    alike = threshold.denominator * both >= threshold.numerator * union
    np.fill_diagonal(alike, False)
    return alike


def _set_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for rows, texts in slices(batches, "text"):
        grams = pa.array([s.tobytes() for s in gram_sets(texts, size)], pa.binary())
        names = [n for n in rows.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in names), grams], names=[*names, "grams"])


def _verify(batches: Iterator[pa.RecordBatch], threshold: Fraction) -> Iterator[pa.RecordBatch]:
    names, parts = ["node", "root", "n_links"], []
    for g in _groups(batches, ["comp", "low", "high"]):
        node, first = np.unique(np.array(g["node"]), return_index=True)
        sets = [np.frombuffer(g["grams"][i], dtype=np.uint64) for i in first]
        alike = jaccard_at_least(sets, threshold)
        if g["low"][0] != g["high"][0]:
            block = np.array(g["block"])[first]
            alike &= block[:, None] != block[None, :]
        links = alike.sum(1)
        some = links > 0
        parts.append((node[some], node[_roots(alike)][some], links[some].astype(np.int64)))
        if len(parts) >= HELD:
            yield _table(parts, names)
            parts = []
    if parts:
        yield _table(parts, names)


def _verified(docs: DataFrame, classes: DataFrame, links: DataFrame, size: int, threshold: float) -> DataFrame:
    """Exact links within the components of the candidate links: node, root (a spanning forest), n_links, per block."""
    comps = materialize(components(links, "node", "root"), "comps").withColumnRenamed("root", "comp")
    inside = classes.select("node", "doc_id", "text_key", "n_grams").join(comps, "node")
    weights = inside.groupBy("comp").agg(F.sum("n_grams").alias("grams"), F.count(F.lit(1)).alias("n"))
    blocks = F.greatest(F.ceil(F.col("grams") / BLOCK_GRAMS), F.ceil(F.col("n") / BLOCK))
    weights = materialize(weights.select("comp", blocks.alias("blocks")), "weights")
    wanted = materialize(inside.join(weights, "comp").drop("n_grams"), "wanted")
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    sets = with_findings(texts, wanted, "doc_id", "text_key").select("node", "comp", "blocks", "text").mapInArrow(
        lambda batches: _set_rows(batches, size), "node bigint, comp bigint, blocks bigint, grams binary"
    )
    by = ["comp", "low", "high"]
    spread = _spread(sets, F.col("blocks"), "node").select(*by, "block", "node", "grams")
    exact = Fraction(str(threshold))
    checked = spread.repartition(*by).sortWithinPartitions(*by).mapInArrow(
        lambda batches: _verify(batches, exact), "node bigint, root bigint, n_links bigint"
    )
    return materialize(checked, "verified")


def _grouped(docs: DataFrame, size: int, threshold: float, target: float) -> DataFrame:
    """Per row: doc_id, text_key, node and the root of its group (NULL without words), class_id, class_size, n_links, group_id."""
    signed = _signed(docs, size)
    classes = _classes(signed)
    verified = _verified(docs, classes, forest_links(classes, threshold, target), size, threshold)
    counts = verified.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    roots = materialize(components(verified, "node", "root"), "roots")
    linked = classes.select("node", "class_id").join(roots, "node").join(counts, "node")
    groups = linked.groupBy("root").agg(F.min("class_id").alias("group_id"))
    linked = materialize(linked.select("node", "root", "n_links").join(groups, "root"), "linked")
    full = classes.select("digest", "node", "class_id", "class_size").join(linked, "node", "left").select(
        "digest", "node", F.coalesce("root", "node").alias("root"), "class_id", "class_size",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("root").isNull(), F.col("class_id")).otherwise(F.col("group_id")).alias("group_id"),
    )
    rows = signed.select("doc_id", "text_key", "digest").join(materialize(full, "full"), "digest", "left")
    alone = F.col("node").isNull()
    return rows.select(
        "doc_id", "text_key", "node", "root",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("group_id")).alias("group_id"),
    )


def similar(docs: DataFrame, size: int = WORDS, threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, n_links, group_id.

    `class_id` is the least id of the documents with the same set of n-grams, `n_links` the number of other classes
    whose coefficient with this one reaches the threshold, `group_id` the least id of all documents that are connected
    by links and classes.
    """
    return _grouped(docs, size, threshold, target).select("doc_id", "class_id", "class_size", "n_links", "group_id")


def keep_one(docs: DataFrame, size: int = WORDS, threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """The rows of `docs` that stay, with their columns: of each group the document with the least id, NULL last.

    Documents without words all stay. If a row that stays is repeated with the same id and text, one of them stays.
    """
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    named = [F.col("key.doc_id"), F.col("key.text_key")]
    with scratch_of_its_own(docs.sparkSession) as keep:
        crowd = _grouped(docs, size, threshold, target).where((F.col("class_size") > 1) | (F.col("n_links") > 0))
        crowd = materialize(crowd.select("root", key.alias("key")), "crowd")
        best = materialize(crowd.groupBy("root").agg(F.min("key").alias("best")), "best")
        judged = crowd.join(best, "root")
        lost = keep(judged.where(F.col("key") != F.col("best")).select(*named).distinct(), "lost")
        again = keep(
            judged.where(F.col("key") == F.col("best")).groupBy(*named).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).drop("n"),
            "again",
        )
    kept = without_findings(packed(docs), lost, "doc_id", "text_key")
    if not again.isEmpty():
        once = with_findings(kept, again, "doc_id", "text_key").dropDuplicates(["doc_id", "text_key"])
        kept = without_findings(kept, again, "doc_id", "text_key").unionByName(once)
    return kept.select("row.*")
