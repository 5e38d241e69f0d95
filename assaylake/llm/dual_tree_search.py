"""Ranked lexical search by two trees: exact top k of all documents for every item of a benchmark.

Documents become sparse vectors over the items' terms, once, and are stored in trees of a few thousand. A document node
holds the largest term value of any document below it, an item node the weight of every term of any item below it, so
the product of both bounds every score of an item below the one and a document below the other. A pair of nodes whose
bound stays under the weakest k-th score of its items is left out with all its documents; other pairs are opened on both
sides, and single documents are scored exactly in whole numbers.

The k-th scores are tight from the start: a first pass walks every tree greedily to one leaf per item. The best score
from each tree belongs to a document of its own, so the k-th largest of them bounds the final k-th score from below.

Items are taken in blocks of bounded size: what goes to the tasks (terms, weights, k-th scores of a block) never exceeds
``BLOCK_BYTES`` of item text, or one item. A tree is bounded in documents and vector entries; long texts are cut into
terms piece by piece.

Nulls: a null text has no terms; a null ``doc_id`` sorts before all others; a null item text, or one without a term that
any document holds, has no rows. Repeated documents are ranked each, equal scores by ascending ``doc_id``; repeated items
are answered each. ``doc_id`` is an integer. Further columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from assaylake.llm.common import slices, stored
from assaylake.session import remove_scratch, scratch_path

TOP = 10
# Item text that is handed to every task at a time.
BLOCK_BYTES = 4 * 1024 * 1024
# A tree is closed once it has so many documents or vector entries; documents in a leaf, children of a node.
TREE_DOCUMENTS, TREE_ENTRIES, LEAF, CHILDREN = 4096, 1_000_000, 8, 8
ITEM_CHILDREN = 8
# Leaves that are scored before the k-th score is looked at again.
STEP = 8
# Bytes of a text that are cut into terms at a time.
PIECE = 1 << 20
# Bounds are sums of doubles: room for their rounding.
ROOM = 1 + 1e-9

_TABLE = bytes(c | 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in lists of bounded length: runs of ASCII letters, digits and all other characters."""
    begin = 0
    while begin < len(text):
        end = begin + PIECE
        if end >= len(text):
            end = len(text)
        else:  # not inside a term
            while end < len(text) and _TABLE[text[end]] != 32:
                end += 1
        yield text[begin:end].translate(_TABLE).split()
        begin = end


class Block:
    """Items and the numbered terms they hold."""

    def __init__(self, rows: list[tuple]):
        self.ids = [item_id for item_id, _ in rows]
        self.numbers: dict[bytes, int] = {}
        self.terms = []
        for _, text in rows:
            found = {t for part in terms_of((text or "").encode()) for t in part}
            self.terms.append(np.array(sorted(self.numbers.setdefault(t, len(self.numbers)) for t in sorted(found)), np.int64))


def item_blocks(items: DataFrame, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """Items one after the other, in blocks of ``most`` bytes of text or one longer item."""
    rows, size = [], 0
    for item_id, text in items.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        one = len((text or "").encode())
        if rows and size + one > most:
            yield Block(rows)
            rows, size = [], 0
        rows.append((item_id, text))
        size += one
    if rows:
        yield Block(rows)


# ---- documents as vectors ----

_VECTORS = (
    "docs long, length long, ids binary, known binary, lengths binary, starts binary, terms binary, counts binary, "
    "holders array<struct<term:int,n:long>>"
)
_ARROW = pa.schema(
    [("docs", pa.int64()), ("length", pa.int64())]
    + [(n, pa.binary()) for n in ("ids", "known", "lengths", "starts", "terms", "counts")]
    + [("holders", pa.list_(pa.struct([("term", pa.int32()), ("n", pa.int64())])))]
)


def _vectors(numbers: dict[bytes, int]):
    """Arrow function: trees of documents that hold a numbered term, and a last row with counts of documents by term."""

    def tree(parts) -> dict:
        ids, known, lengths, sizes, terms, counts = (np.concatenate(x) for x in zip(*parts))
        starts = np.concatenate(([0], np.cumsum(sizes)))
        packed = zip(_ARROW.names[2:8], (ids, known, lengths, starts, terms.astype(np.int32), counts.astype(np.int32)))
        return {"docs": 0, "length": 0, "holders": None} | {n: x.tobytes() for n, x in packed}

    def build(batches):
        get, width = numbers.get, max(1, len(numbers))
        holders, docs, length = np.zeros(width, np.int64), 0, 0
        parts, held, entries = [], 0, 0
        for batch in slices(batches):
            ids = batch.column(0)
            known = np.asarray(ids.is_valid().to_numpy(zero_copy_only=False), bool)
            ids = np.asarray(ids.fill_null(0).to_numpy(zero_copy_only=False), np.int64)
            rows, sizes = [], np.zeros(batch.num_rows, np.int64)
            for i, text in enumerate(batch.column(1).cast(pa.binary())):
                if text.is_valid:
                    for part in terms_of(text.as_py()):
                        sizes[i] += len(part)
                        found = np.fromiter(map(get, part, repeat(-1)), np.int64, len(part))
                        rows.append(found[found >= 0] + i * width)
            docs, length = docs + int((sizes > 0).sum()), length + int(sizes.sum())
            keys, counts = np.unique(np.concatenate(rows) if rows else np.empty(0, np.int64), return_counts=True)
            if not len(keys):
                continue
            of, terms = np.divmod(keys, width)
            holders += np.bincount(terms, minlength=width)
            present, per = np.unique(of, return_counts=True)
            parts.append((ids[present], known[present], sizes[present], per, terms, counts))
            held, entries = held + len(present), entries + len(terms)
            if held >= TREE_DOCUMENTS or entries >= TREE_ENTRIES:
                yield pa.RecordBatch.from_pylist([tree(parts)], _ARROW)
                parts, held, entries = [], 0, 0
        if parts:
            yield pa.RecordBatch.from_pylist([tree(parts)], _ARROW)
        some = np.flatnonzero(holders)
        last = {n: None for n in _ARROW.names}
        last |= {"docs": docs, "length": length, "holders": [{"term": int(t), "n": int(holders[t])} for t in some]}
        yield pa.RecordBatch.from_pylist([last], _ARROW)

    return build


# ---- trees ----


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of ranges, one range behind the other."""
    before = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


class Level:
    """Coordinate maxima of the nodes of one level, by term."""

    def __init__(self, terms: np.ndarray, nodes: np.ndarray, values: np.ndarray, size: int, width: int):
        keys = terms * size + nodes
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        self.terms, self.nodes = np.divmod(keys[first], size)
        self.values = np.maximum.reduceat(values[order], first)
        self.starts = np.searchsorted(self.terms, np.arange(width + 1))
        self.size = size

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        lengths = self.starts[terms + 1] - self.starts[terms]
        at = ranges(self.starts[terms], lengths)
        return np.bincount(self.nodes[at], np.repeat(weights, lengths) * self.values[at], self.size)


class DocumentTree:
    """Documents of alike language and length next to each other, and the levels above them, topmost first."""

    def __init__(self, row: dict, stats: Stats):
        read = lambda name, kind: np.frombuffer(row[name], kind)
        starts, terms, counts = read("starts", np.int64), read("terms", np.int32).astype(np.int64), read("counts", np.int32)
        lengths = read("lengths", np.int64)
        per = np.diff(starts)
        # The commonest term of a document tells its language.
        commonest = np.minimum.reduceat(stats.places[terms], starts[:-1])
        order = np.lexsort((lengths, commonest))
        at = ranges(starts[:-1][order], per[order])
        terms, counts, lengths, per = terms[at], counts[at].astype(np.int64), lengths[order], per[order]
        self.ids, self.known = read("ids", np.int64)[order], read("known", np.bool_)[order]
        self.starts = np.concatenate(([0], np.cumsum(per)))
        spread = 100 - 90 + (90 * lengths * stats.docs) // stats.length
        self.terms = terms
        self.values = (1_000_000_000 * counts) // (1000 * counts + 8 * np.repeat(spread, per))
        nodes = np.repeat(np.arange(len(per)) // LEAF, per)
        level = Level(terms, nodes, self.values, -(-len(per) // LEAF), stats.width)
        self.levels = [level]
        while level.size > CHILDREN:
            level = Level(level.terms, level.nodes // CHILDREN, level.values, -(-level.size // CHILDREN), stats.width)
            self.levels.insert(0, level)

    def below(self, depth: int, nodes: np.ndarray) -> np.ndarray:
        """Children, one level down, of nodes of a level."""
        return self._spread(nodes, CHILDREN, self.levels[depth + 1].size)

    @staticmethod
    def _spread(nodes: np.ndarray, each: int, size: int) -> np.ndarray:
        found = (nodes[:, None] * each + np.arange(each)).ravel()
        return found[found < size]

    def documents(self, leaves: np.ndarray) -> np.ndarray:
        return self._spread(leaves, LEAF, len(self.ids))

    def scores(self, documents: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores; ``weights`` by term, in whole numbers."""
        lengths = self.starts[documents + 1] - self.starts[documents]
        at = ranges(self.starts[documents], lengths)
        before = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        return np.add.reduceat(weights[self.terms[at]] * self.values[at], before)


class Stats:
    """What scores need of the whole corpus, and the tree of items, topmost level first."""

    def __init__(self, block_terms: list[np.ndarray], width: int, docs: int, length: int, holders: dict[int, int]):
        self.docs, self.length, self.width = docs, length, width
        df = np.array([holders.get(t, 0) for t in range(width)], np.int64)
        self.weights = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        self.places = np.empty(width, np.int64)  # 0 for the term that most documents hold
        self.places[np.argsort(-df, kind="stable")] = np.arange(width)
        useful = [t[(df[t] > 0) & (self.weights[t] > 0)] for t in block_terms]
        # Items that share their commonest terms stand next to each other; items without any useful term can't score.
        able = [i for i, t in enumerate(useful) if len(t)]
        able.sort(key=lambda i: sorted(self.places[useful[i]].tolist())[:4])
        self.items = [(i, useful[i]) for i in able]
        level = [(np.array([n]), t) for n, (_, t) in enumerate(self.items)]
        self.levels = [level]
        while len(level) > 1:
            groups = [level[k : k + ITEM_CHILDREN] for k in range(0, len(level), ITEM_CHILDREN)]
            level = [(np.concatenate([m for m, _ in g]), np.unique(np.concatenate([t for _, t in g]))) for g in groups]
            self.levels.insert(0, level)


class Search:
    """Best documents of every item, over trees that come one after the other."""

    def __init__(self, stats: Stats, least: np.ndarray, top: int):
        self.stats, self.top = stats, top
        self.least = least.copy()  # a score below it can't be among the best
        self.best: list[list[tuple]] = [[] for _ in stats.items]  # (-score, has id, id)
        self.weights = np.zeros(stats.width, np.int64)

    def add(self, tree: DocumentTree) -> None:
        self._open(tree, 0, 0, 0, np.arange(tree.levels[0].size))

    def _open(self, tree: DocumentTree, item_depth: int, node: int, depth: int, nodes: np.ndarray) -> None:
        """Open a node of items against nodes of documents of one level."""
        items, terms = self.stats.levels[item_depth][node]
        bounds = tree.levels[depth].bounds(terms, self.stats.weights[terms])[nodes] * ROOM
        keep = (bounds > 0) & (bounds >= self.least[items].min())
        nodes, bounds = nodes[keep], bounds[keep]
        if not len(nodes):
            return
        last_items, last_nodes = item_depth + 1 == len(self.stats.levels), depth + 1 == len(tree.levels)
        if last_items and last_nodes:
            self._score(tree, node, terms, nodes, bounds)
            return
        if not last_nodes:
            nodes, depth = tree.below(depth, nodes), depth + 1
        if last_items:
            self._open(tree, item_depth, node, depth, nodes)
            return
        for child in range(node * ITEM_CHILDREN, min((node + 1) * ITEM_CHILDREN, len(self.stats.levels[item_depth + 1]))):
            self._open(tree, item_depth + 1, child, depth, nodes)

    def _score(self, tree: DocumentTree, item: int, terms: np.ndarray, leaves: np.ndarray, bounds: np.ndarray) -> None:
        order = np.argsort(-bounds, kind="stable")
        leaves, bounds = leaves[order], bounds[order]
        self.weights[terms] = self.stats.weights[terms]
        for begin in range(0, len(leaves), STEP):
            now = slice(begin, begin + STEP)
            if bounds[begin] < self.least[item]:
                break
            documents = tree.documents(leaves[now])
            scores = tree.scores(documents, self.weights)
            good = (scores > 0) & (scores >= self.least[item])
            if good.any():
                found = documents[good]
                rows = zip((-scores[good]).tolist(), tree.known[found].tolist(), tree.ids[found].tolist())
                self.best[item] = sorted(self.best[item] + list(rows))[: self.top]
                if len(self.best[item]) == self.top:
                    self.least[item] = max(self.least[item], -self.best[item][-1][0])
        self.weights[terms] = 0

    def glance(self, tree: DocumentTree) -> Iterator[tuple[int, int]]:
        """(item, score) of the best document in the leaf that a greedy walk from the root comes to."""
        for item, (_, terms) in enumerate(self.stats.items):
            weights, nodes = self.stats.weights[terms], np.arange(tree.levels[0].size)
            for depth, level in enumerate(tree.levels):
                nodes = nodes[[np.argmax(level.bounds(terms, weights)[nodes])]]
                if depth + 1 < len(tree.levels):
                    nodes = tree.below(depth, nodes)
            self.weights[terms] = weights
            score = int(tree.scores(tree.documents(nodes), self.weights).max())
            self.weights[terms] = 0
            if score > 0:
                yield item, score


def _trees(batches, stats: Stats) -> Iterator[DocumentTree]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield DocumentTree(batch.slice(k, 1).to_pylist()[0], stats)


def _glances(shared, top: int):
    schema = pa.schema([("item", pa.int32()), ("score", pa.int64())])

    def build(batches):
        search = Search(shared.value, np.zeros(len(shared.value.items), np.int64), top)
        for tree in _trees(batches, shared.value):
            found = list(search.glance(tree))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t.type) for k, t in enumerate(schema)], schema=schema)

    return build


def _searches(shared, least: np.ndarray, top: int):
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def build(batches):
        search = Search(shared.value, least, top)
        for tree in _trees(batches, shared.value):
            search.add(tree)
        found = [(i, doc_id if known else None, -score) for i, best in enumerate(search.best) for score, known, doc_id in best]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t.type) for k, t in enumerate(schema)], schema=schema)

    return build


def _answers(spark: SparkSession, docs: DataFrame, block: Block, top: int) -> DataFrame:
    """(item_id, rank, doc_id, score) for one block of items."""
    path = scratch_path(spark, "vectors")
    docs.mapInArrow(_vectors(block.numbers), _VECTORS).write.parquet(path)
    vectors = spark.read.schema(_VECTORS).parquet(path)
    docs_n, length = vectors.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("length"), F.lit(0))).first()
    one = F.explode("holders").alias("h")
    # One row per term of the block.
    holders = dict(map(tuple, vectors.select(one).groupBy("h.term").agg(F.sum("h.n")).collect()))
    stats = Stats(block.terms, len(block.numbers), docs_n, length, holders)
    if not stats.items:
        remove_scratch(spark, path)
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    shared = spark.sparkContext.broadcast(stats)
    trees = vectors.filter(F.col("ids").isNotNull()).drop("holders", "docs", "length")
    glances = trees.mapInArrow(_glances(shared, top), "item int, score long")
    place = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score")))
    high = glances.select("item", "score", place.alias("place")).filter(F.col("place") <= top)
    full = high.groupBy("item").agg(F.min("score").alias("score"), F.count("*").alias("n")).filter(F.col("n") == top)
    least = np.zeros(len(stats.items), np.int64)
    for item, score, _ in full.collect():  # one row per item of the block
        least[item] = score
    found = trees.mapInArrow(_searches(shared, least, top), "item int, doc_id long, score long")
    best = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    ids = spark.createDataFrame([(n, block.ids[i]) for n, (i, _) in enumerate(stats.items)], "block_item int, item_id long")
    answers = found.join(F.broadcast(ids), found["item"] == ids["block_item"])
    answers = stored(answers.select("item_id", "rank", "doc_id", "score"), "answers")
    remove_scratch(spark, path)
    return answers


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents with the highest scores above 0, for each item."""
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(items, block_bytes):
        out = out.unionByName(_answers(spark, plain, block, top))
    return out
