"""Exact removal of passages that an earlier document holds, by a sparse, range-partitioned suffix array.

*Which suffixes.* Every string of ``LENGTH`` bytes has anchors: the places of its least gram of ``GRAM`` bytes under
a hash. Equal strings have equal anchors, so suffixes that start at anchors are enough, about one byte in fifteen.
Anchors whose gram no other document of the corpus holds are dropped after one exchange of gram hashes.

*Sorting.* The remaining suffixes, with the few bytes before them that a string can reach back, go to ranges of
their leading tokens (the gram). The splitters are sampled. A bucket sorts its suffixes by a multikey quicksort, eight
bytes at a time, ties only, and takes common prefixes from neighbours; strings at the same distance from their anchor
are equal where a run of common prefixes meets a run of common reversed contexts, and each learns whether an earlier
document has it. A splitter is a whole gram and a bucket starts with all suffixes that share it, so the suffixes on
both sides of a boundary differ in their leading tokens: no match crosses one.

*What travels.* A suffix carries only the bytes that its strings cover, and a bucket of documents sends suffixes that
agree in them once, with their first document.

*Hot passages.* Buckets tell with a gram's hash how many suffixes they would send for it. A gram with more than
``MOST_SUFFIXES``, as many as a range is planned for, would fill a range alone. Its strings are sent apart, by a
128-bit digest of all their bytes, to ranges of digests: only equality is asked of them, and equal ones have the same
gram, so all of them are sent apart. A phrase in a third of all documents, shorter than a string and followed by other
text each time, fills no range, and a passage that many documents copy stays in the suffix order until it would.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm.buckets import ANSWER, ASK, KEY_BYTES, answers, asked, bucketed
from assaylake.llm.common import groups_for, text_bytes

# Bytes of a string whose earlier occurrence removes it.
LENGTH = 50
GRAM = 20
WINDOW = LENGTH - GRAM + 1  # grams of a string; places its anchor can have
BEFORE = LENGTH - GRAM  # bytes before an anchor that a string can reach
CONTEXT = BEFORE + LENGTH
GROUP_TEXT = 2 * 1024 * 1024
# Text behind one range of gram hashes, and behind one range of suffixes.
HASHED_TEXT, SORTED_TEXT = 32 * 1024 * 1024, 4 * 1024 * 1024
# Suffixes of one gram beyond which its strings are sent apart: those of the text that a range is planned for.
MOST_SUFFIXES = SORTED_TEXT // 16
# The sample for splitters: a share of the documents (all of them if they are few), and grams kept of it per range.
SAMPLE_SHARE, SAMPLE_DOCUMENTS, SAMPLE_GRAMS = 1 / 64, 2_000, 32
NO_ID = np.iinfo(np.int64).max
# With the number of suffixes of a key: more than one document of the bucket holds it. Answers about a key.
SEVERAL = np.uint32(1 << 31)
SHARED, HOT = 1, 2

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours, by doubling."""
    reach, best = 1, values
    while 2 * reach <= width:
        best = pick(best[:-reach], best[reach:])
        reach *= 2
    rest = width - reach
    return pick(best[: len(best) - rest], best[rest:]) if rest else best


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A mixed 64-bit hash of the ``gram`` bytes from every place, by doubling."""
    h, reach, power, total, offset = data.astype(np.uint64) + np.uint64(1), 1, _BASE, None, 0
    left = gram
    while left:
        if left & 1:
            piece = h[offset:]
            total = piece if total is None else total[: len(piece)] * power + piece[: len(total)]
            offset += reach
        left >>= 1
        if left:
            h = h[:-reach] * power + h[reach:]
            with np.errstate(over="ignore"):
                power = power * power
            reach *= 2
    total = total[: len(data) - gram + 1]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xD6E8FEB86659FD93)
    total ^= total >> np.uint64(29)
    return total


class Texts:
    """The documents of a bucket as one array of bytes, with the anchors of all their strings."""

    def __init__(self, table: pa.Table):
        self.ids = [NO_ID if i is None else i for i in table["doc_id"].to_pylist()]
        blobs = [t.encode() for t in table["text"].to_pylist()]
        self.ends = np.cumsum([len(b) for b in blobs]).astype(np.int64)
        self.begins = self.ends - np.array([len(b) for b in blobs], np.int64)
        self.data = np.frombuffer(b"".join(blobs), np.uint8)
        n = len(self.data)
        if n < LENGTH:
            self.anchors, self.keys, self.least = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
            self.hashes = self.all_hashes = self.keys
            return
        h = gram_hashes(self.data)
        least = _sliding(h, WINDOW, np.minimum)  # by start of a string
        crossing = np.ones(len(least), bool)
        for begin, end in zip(self.begins.tolist(), self.ends.tolist()):
            if end - begin >= LENGTH:
                crossing[begin : end - LENGTH + 1] = False
        least[crossing] = 0
        pad = np.zeros(WINDOW - 1, np.uint64)
        most = _sliding(np.concatenate([pad, least, pad]), WINDOW, np.maximum)
        self.anchors = np.flatnonzero((most == h) & (most != 0))
        self.hashes, self.least, self.all_hashes = h[self.anchors], least, h
        # Anchors have small hashes; as keys they are spread evenly again.
        self.keys = self.hashes * _BASE

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, side="right")

    def asked_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Different keys, and how many suffixes with different surroundings they have here, with ``SEVERAL``."""
        if not len(self.anchors):
            return self.keys, np.zeros(0, np.uint32)
        docs = np.array(self.ids, np.int64)[self.doc_of(self.anchors)]
        order = np.argsort(self.keys)
        keys, docs = self.keys[order], docs[order]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        first = np.flatnonzero(new)
        several = np.minimum.reduceat(docs, first) != np.maximum.reduceat(docs, first)
        counts = np.diff(np.append(first, len(keys))).astype(np.uint32)
        often = np.flatnonzero(np.repeat(counts > 1, counts))
        if len(often):
            around = self._neighbours(self.anchors[order[often]])
            run = np.cumsum(new)[often]
            by = np.lexsort((around, run))
            fresh = np.concatenate([[True], (run[by][1:] != run[by][:-1]) | (around[by][1:] != around[by][:-1])])
            counts[counts > 1] = np.add.reduceat(fresh, np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])))
        return keys[first], counts | np.where(several, SEVERAL, np.uint32(0))

    def _neighbours(self, places: np.ndarray) -> np.ndarray:
        """A hash of the bytes around a place, from the hashes of grams that cover them."""
        h = np.zeros(len(places), np.uint64)
        for step in range(-BEFORE, LENGTH - GRAM + 1, GRAM):
            h = (h ^ self.all_hashes[np.clip(places + step, 0, len(self.all_hashes) - 1)]) * _BASE
            h ^= h >> np.uint64(32)
        return h

    def suffixes(self, heard: np.ndarray) -> dict[str, np.ndarray]:
        """What another document may share, anchored suffixes first and strings sent apart behind them.

        ``place``, ``doc`` and ``bits`` (one per string: it starts so many bytes before the place) of each; ``around``
        of the suffixes and ``digest`` of the strings.
        """
        unique, _ = self.asked_keys()
        answer = heard[np.searchsorted(unique, self.keys)] if len(unique) else np.zeros(0, np.uint8)
        shared = answer >= SHARED
        places, hashes, hot = self.anchors[shared], self.hashes[shared], answer[shared] == HOT
        # strings[i, a]: the string that starts ``a`` bytes before the anchor has it as its anchor
        reach = np.concatenate([np.zeros(WINDOW - 1, np.uint64), self.least, np.zeros(LENGTH, np.uint64)])
        strings = sliding_window_view(reach, WINDOW)[places][:, ::-1] == hashes[:, None]
        # Strings of hot grams are sent by themselves, from where they start.
        rows, a = np.nonzero(strings & hot[:, None])
        apart = np.unique(places[rows] - a)
        strings, places = strings[~hot], places[~hot]
        padded = np.concatenate([np.zeros(BEFORE, np.uint8), self.data, np.zeros(LENGTH, np.uint8)])
        around = sliding_window_view(padded, CONTEXT)[places]
        most, fewest = WINDOW - 1 - strings[:, ::-1].argmax(1), strings.argmax(1)
        span = np.arange(-BEFORE, LENGTH)
        around[(span < -most[:, None]) | (span >= LENGTH - fewest[:, None])] = 0
        bits = (strings.astype(np.uint32) << np.arange(WINDOW, dtype=np.uint32)).sum(1, dtype=np.uint32)
        every = np.concatenate([places, apart])
        return {
            "place": every,
            "doc": self.doc_of(every),
            "bits": np.concatenate([bits, np.ones(len(apart), np.uint32)]),
            "around": around,
            "digest": string_digests(sliding_window_view(padded, LENGTH)[apart + BEFORE]),
        }


def judged(table: pa.Table) -> pa.Table:
    """For every bucket that asked, whether each of its keys is held by one document, several, or too many for a range."""
    packed = np.frombuffer(b"".join(table["keys"].to_pylist()), np.uint8).reshape(-1, KEY_BYTES)
    keys = np.zeros((len(packed), 8), np.uint8)
    keys[:, :KEY_BYTES] = packed
    keys = keys.view(">u8").ravel().astype(np.uint64)
    counts = np.frombuffer(b"".join(table["counts"].to_pylist()), np.uint32)
    order = np.argsort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
    held = np.diff(np.append(first, len(keys)))
    several = np.maximum.reduceat(counts[order], first) >= SEVERAL
    suffixes = np.add.reduceat((counts[order] & ~SEVERAL).astype(np.int64), first)
    verdict = np.where((held > 1) | several, np.where(suffixes > MOST_SUFFIXES, HOT, SHARED), 0).astype(np.uint8)
    answer = np.empty(len(keys), np.uint8)
    answer[order] = np.repeat(verdict, held)
    bodies = [x.tobytes() for x in np.split(answer, np.cumsum(table["size"].to_numpy())[:-1])]
    return _answer(table["bucket"], 0, table["part"], bodies)


def _answer(bucket, kind: int, part, bodies: list[bytes]) -> pa.Table:
    kinds = pa.array([kind] * len(bodies), pa.int32())
    columns = [bucket.combine_chunks(), kinds, part.combine_chunks(), pa.array(bodies, pa.binary())]
    return pa.Table.from_arrays(columns, names=["bucket", "kind", "part", "body"])


def string_digests(strings: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of every row of bytes."""
    padded = np.zeros((len(strings), -(-strings.shape[1] // 8) * 8), np.uint8)
    padded[:, : strings.shape[1]] = strings
    words = padded.view(np.uint64)
    found = np.zeros((len(strings), 2), np.uint64)
    for side, factor in enumerate((_BASE, np.uint64(0xD6E8FEB86659FD93))):
        h = np.full(len(strings), side + 1, np.uint64)
        for k in range(words.shape[1]):
            h = (h ^ words[:, k]) * factor
            h ^= h >> np.uint64(29 + side)
        found[:, side] = h
    return found


def surroundings_hashes(around: np.ndarray, bits: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(around).view(np.uint64)
    h = bits.astype(np.uint64)
    for k in range(words.shape[1]):
        h = (h ^ words[:, k]) * _BASE
        h ^= h >> np.uint64(32)
    return h


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of the first of equals, in an order of their own, and for every row the number of its kind."""
    _, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
    return first, kind


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of byte rows: sorted by eight bytes, then only ties by the next eight, and so on."""
    width = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), width), np.uint8)
    padded[:, : rows.shape[1]] = rows
    words = padded.view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0], kind="quicksort")
    new = np.concatenate([[True], words[order[1:], 0] != words[order[:-1], 0]]) if len(order) else np.zeros(0, bool)
    for depth in range(1, words.shape[1]):
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        run = np.cumsum(new)[at]
        values = words[order[at], depth]
        inner = np.lexsort((values, run))
        order[at] = order[at][inner]
        values, run = values[inner], run[inner]
        differs = np.concatenate([[True], (values[1:] != values[:-1]) | (run[1:] != run[:-1])])
        new[at] |= differs
    return order


def common_prefixes(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each sorted row shares with the one before it (0 for the first)."""
    ordered = rows[order]
    differs = ordered[1:] != ordered[:-1]
    shared = np.where(differs.any(1), differs.argmax(1), rows.shape[1])
    return np.concatenate([[0], shared])[: len(order)]


def earlier_strings(around: np.ndarray, bits: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For every suffix, a bit per string: a smaller document of the bucket holds the same string."""
    right, left = around[:, BEFORE:], around[:, BEFORE - 1 :: -1]
    order = multikey_order(right)
    shared = common_prefixes(right, order)
    left_order = multikey_order(left)
    left_shared = common_prefixes(left, left_order)
    earlier = np.zeros(len(bits), np.uint32)
    runs = np.empty(len(bits), np.int64)
    left_runs = np.empty(len(bits), np.int64)
    for a in range(WINDOW):  # a: bytes of the string before its anchor
        runs[order] = np.cumsum(shared < LENGTH - a)
        rows = np.flatnonzero((bits >> np.uint32(a)) & np.uint32(1))
        rows = rows[np.bincount(runs[rows], minlength=1)[runs[rows]] > 1]
        if not len(rows):
            continue
        if a:
            left_runs[left_order] = np.cumsum(left_shared < a)
            key = runs[rows] * (len(bits) + 1) + left_runs[rows]
        else:
            key = runs[rows]
        by = np.argsort(key)
        key, rows = key[by], rows[by]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        least = np.repeat(np.minimum.reduceat(docs[rows], first), np.diff(np.append(first, len(rows))))
        hit = rows[least < docs[rows]]
        earlier[hit] |= np.uint32(1 << a)
    return earlier


def _leading(around: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(around[:, BEFORE : BEFORE + GRAM]).view(f"S{GRAM}").ravel()


def digest_ranges(digest: np.ndarray, ranges: int) -> np.ndarray:
    """Range of every string sent apart, below those of suffixes."""
    return -1 - ((digest[:, 1] >> np.uint64(16)) % np.uint64(ranges)).astype(np.int64)


def earlier_digests(digest: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For every string sent apart, 1 where a smaller document has the same."""
    order = np.lexsort((docs, digest[:, 1], digest[:, 0]))
    ordered = digest[order]
    new = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(1)])
    least = docs[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    earlier = np.zeros(len(docs), np.uint32)
    earlier[order] = least < docs[order]
    return earlier


def _splitters(docs: DataFrame, total: int, ranges: int) -> np.ndarray:
    """Grams that cut the suffixes of sampled documents into equal ranges; the sample grows with the ranges."""
    if ranges < 2:
        return np.zeros(0, f"S{GRAM}")
    share = min(1.0, max(SAMPLE_SHARE, SAMPLE_DOCUMENTS / max(1, docs.count())))
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).sample(share, seed=7)
    # Of some total / 16 anchors in all, the share of those sampled that gives so many grams a range.
    step = max(1, int(share * total / 16 / (SAMPLE_GRAMS * ranges)))

    def run(batches):
        for batch in batches:
            texts = Texts(pa.Table.from_batches([batch]))
            places = texts.anchors[(texts.keys >> np.uint64(20)) % np.uint64(step) == 0]
            yield pa.RecordBatch.from_arrays([pa.array([texts.data[p : p + GRAM].tobytes() for p in places], pa.binary())], names=["gram"])

    found = sample.mapInArrow(run, "gram binary").toArrow()
    grams = np.sort(np.array(found["gram"].to_pylist(), f"S{GRAM}"))
    if not len(grams):
        return np.zeros(0, f"S{GRAM}")
    return np.unique(grams[[len(grams) * i // ranges for i in range(1, ranges)]])


SEND = "range int, bucket int, size long, around binary, bits binary, docs binary"
RESULT = "n_bytes long, n_removed long, n_spans long, kept binary"


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): bytes covered by a string of an earlier document removed.

    A string of ``LENGTH`` bytes is removed if it also starts in a document with a smaller doc_id; rows without
    doc_id come last, and rows that share a doc_id do not count against each other. Strings are judged on the input.
    Null text counts as empty; shorter texts are kept whole. ``kept`` holds the remaining bytes, which need not be
    valid UTF-8. An empty table gives an empty result.
    """
    total = text_bytes(docs)
    buckets = groups_for(total, GROUP_TEXT)
    parts = groups_for(total, HASHED_TEXT)
    ranges = groups_for(total, SORTED_TEXT)
    splitters = _splitters(docs, total, ranges)
    dealt = bucketed(docs, buckets).drop("version")
    kind = dict(docs.dtypes)["doc_id"]

    def ask(table: pa.Table) -> pa.Table:
        return asked(table["bucket"][0].as_py(), *Texts(table).asked_keys(), parts)

    def prepared(table: pa.Table, heard: pa.Table):
        texts = Texts(table)
        found = texts.suffixes(answers(heard, 0, np.uint8))
        own = len(found["around"])
        first, number = distinct(surroundings_hashes(found["around"], found["bits"][:own]))
        to = np.searchsorted(splitters, _leading(found["around"][first]), side="right") if own else np.zeros(0, np.int64)
        sent_apart, number_apart = distinct(found["digest"][:, 0])
        number = np.concatenate([number, len(first) + number_apart])
        to = np.concatenate([to, digest_ranges(found["digest"][sent_apart], ranges)])
        first = np.concatenate([first, own + sent_apart])
        docs_of = np.array(texts.ids, np.int64)[found["doc"]] if len(number) else np.zeros(0, np.int64)
        least = np.full(len(first), NO_ID)
        np.minimum.at(least, number, docs_of)
        return texts, found, first, number, docs_of, least, to, np.argsort(to, kind="stable")

    def send(table: pa.Table, heard: pa.Table) -> pa.Table:
        rows = []
        if table.num_rows:
            bucket = table["bucket"][0].as_py()
            _, found, first, _, _, least, to, by = prepared(table, heard)
            own = len(found["around"])
            squeeze = zstandard.ZstdCompressor(level=3).compress
            cuts = np.flatnonzero(np.concatenate([[True], to[by][1:] != to[by][:-1]])) if len(by) else []
            for part in np.split(by, cuts[1:]) if len(by) else []:
                at = first[part]
                to_range = int(to[part[0]])
                if to_range < 0:
                    bodies = found["digest"][at - own].tobytes(), b"", squeeze(least[part].tobytes())
                else:
                    bodies = [squeeze(x.tobytes()) for x in (found["around"][at], found["bits"][at], least[part])]
                rows.append((to_range, bucket, len(part), *bodies))
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=[c.split()[0] for c in SEND.split(", ")])

    def compare(table: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor().decompress
        whole = lambda column: b"".join(expand(b) for b in table[column].to_pylist())
        first = np.frombuffer(whole("docs"), np.int64)
        if table["range"][0].as_py() < 0:
            earlier = earlier_digests(np.frombuffer(b"".join(table["around"].to_pylist()), np.uint64).reshape(-1, 2), first)
        else:
            around = np.frombuffer(whole("around"), np.uint8).reshape(-1, CONTEXT)
            earlier = earlier_strings(around, np.frombuffer(whole("bits"), np.uint32), first)
        return _answer(table["bucket"], 1, table["range"], [x.tobytes() for x in np.split(earlier, np.cumsum(table["size"].to_numpy())[:-1])])

    def remove(table: pa.Table, heard: pa.Table) -> pa.Table:
        out = []
        if table.num_rows:
            texts, found, first, number, docs_of, least, _, by = prepared(table, heard)
            earlier = np.zeros(len(first), np.uint32)
            earlier[by] = answers(heard, 1, np.uint32)
            edges = np.zeros(len(texts.data) + 1, np.int32)
            if len(number):
                own = found["bits"]
                gone = np.where(docs_of > least[number], own, own & earlier[number])
                rows, a = np.nonzero((gone[:, None] >> np.arange(WINDOW, dtype=np.uint32)) & np.uint32(1))
                starts = np.unique(found["place"][rows] - a)
                edges[starts] += 1
                np.subtract.at(edges, starts + LENGTH, 1)
            covered = np.cumsum(edges[:-1]) > 0
            for begin, end in zip(texts.begins.tolist(), texts.ends.tolist()):
                hole = covered[begin:end]
                spans = int(hole[:1].sum() + (hole[1:] & ~hole[:-1]).sum())
                out.append((end - begin, int(hole.sum()), spans, texts.data[begin:end][~hole].tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.Table.from_arrays(
            [table["doc_id"].combine_chunks(), *[pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)]], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        )

    totals = dealt.groupBy("bucket").applyInArrow(ask, ASK).groupBy("part").applyInArrow(judged, ANSWER)
    sent = dealt.groupBy("bucket").cogroup(totals.groupBy("bucket")).applyInArrow(send, SEND)
    compared = sent.groupBy("range").applyInArrow(compare, ANSWER)
    heard = totals.unionByName(compared)
    return dealt.groupBy("bucket").cogroup(heard.groupBy("bucket")).applyInArrow(remove, f"doc_id {kind}, {RESULT}")


def removal_digests(docs: DataFrame) -> DataFrame:
    done = suffix_dedup(docs)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
