"""Benchmark decontamination by multi-pattern search after Wu and Manber (1994), over words in place of bytes.

Patterns are the windows of the test items: ``window`` consecutive words, or all words of a shorter item. Patterns of
one length share a shift table indexed by a block of words: it tells how far the search may move on because no pattern
has that block nearer to its end. Where the shift is 0, the block's bucket selects patterns, and a comparison of the
words themselves confirms each occurrence. Documents are searched in stretches side by side: every stretch moves by its
own shifts until it leaves its range, so most positions are never looked at.

Defined results: null and empty texts have no words and are clean. An item without words has no window. Equal windows of
several items count for each. Repeated documents are rows of their own. Items with a repeated id count once; the words
of an item without an id are hit, but it is no item of the result. An empty item table leaves all documents clean. Extra columns are ignored; ``carry`` returns the wanted ones.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._common import drop_stored, map_text, stored

WINDOW = 13
BLOCK = 3
TABLE_BITS = 20
#: Item text held at once by a task and the driver; more items are searched in further passes of that size.
PASS_BYTES = 32 << 20


@dataclass
class Length:
    """The patterns of one length in words; several may share a hash."""

    size: int
    block: int
    shifts: np.ndarray
    hashes: np.ndarray  # sorted pattern hashes
    first: np.ndarray  # each pattern's place among the items' words
    ends: np.ndarray  # owners[ends[i] : ends[i + 1]] are pattern i's items
    owners: np.ndarray


@dataclass
class Patterns:
    """Item words once, as bytes and hashes; patterns are places in them, so memory is a small multiple of the text."""

    raw: bytes = b""
    starts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    stops: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    items: list = field(default_factory=list)
    lengths: list[Length] = field(default_factory=list)

    @staticmethod
    def build(rows: list[tuple], window: int = WINDOW, block: int = BLOCK) -> Patterns:
        """From (item id, text) rows."""
        texts = [(text or "").encode("utf-8", "surrogatepass") for _, text in rows]
        flat = _text.LOWER[np.frombuffer(b"".join(texts), dtype=np.uint8)]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        starts, stops, bound = _text.spans(flat, offsets, _text.ALNUM_OR_HIGH)
        words = _text.span_hashes(flat, starts, stops)
        ids = {item: k for k, item in enumerate(dict.fromkeys(item for item, _ in rows))}
        owner = np.array([ids[item] for item, _ in rows], dtype=np.int64)
        n = np.diff(bound)
        out = Patterns(flat.tobytes(), starts.astype(np.int32 if len(flat) < 1 << 31 else np.int64), stops.astype(np.int32 if len(flat) < 1 << 31 else np.int64), list(ids))
        for size in sorted({min(window, int(x)) for x in n if x}):
            rows_of = np.flatnonzero(np.minimum(n, window) == size)
            counts = n[rows_of] - size + 1
            places = np.repeat(bound[:-1][rows_of], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            out.lengths.append(_length(size, min(block, size), words, places, np.repeat(owner[rows_of], counts)))
        return out

    def text(self, place: int, size: int) -> list[bytes]:
        return [self.raw[a:z] for a, z in zip(self.starts[place : place + size].tolist(), self.stops[place : place + size].tolist())]


def _windows(words: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place on."""
    h = np.zeros(len(places), dtype=np.uint64)
    for k in range(size):
        h = h * np.uint64(_text.BASE) + words[places + k]
    return _text.mix(h)


def _length(size: int, block: int, words: np.ndarray, places: np.ndarray, owner: np.ndarray) -> Length:
    hashes, second = _windows(words, places, size), _windows(words ^ _text.MIX_A, places, size)
    order = np.lexsort((owner, second, hashes))
    hashes, second, places, owner = hashes[order], second[order], places[order], owner[order]
    fresh = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (second[1:] != second[:-1])])
    one = fresh | np.concatenate([[True], owner[1:] != owner[:-1]])  # an item counts once for each pattern
    first = places[fresh]
    far = size - block + 1
    shifts = np.full(1 << TABLE_BITS, far, dtype=np.uint8 if far < 256 else np.int64)
    for end in range(block - 1, size):  # ascending, so that the smallest shift stays
        shifts[_slot(_windows(words, first + end - block + 1, block))] = size - 1 - end
    ends = np.append(np.flatnonzero(fresh[one]), one.sum())
    return Length(size, block, shifts, hashes[fresh], first.astype(np.int64), ends, owner[one])


def _poly(words: np.ndarray) -> np.ndarray:
    h = np.zeros(len(words), dtype=np.uint64)
    for k in range(words.shape[1]):
        h = h * np.uint64(_text.BASE) + words[:, k]
    return _text.mix(h)


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def ends_found(words: np.ndarray, bound: np.ndarray, p: Length) -> tuple[np.ndarray, np.ndarray]:
    """(last word, pattern) of the occurrences by hash. ``bound``: offsets of the documents in ``words``."""
    n, far = len(words), p.size - p.block + 1
    none = np.zeros(0, dtype=np.int64)
    if n < p.size:
        return none, none
    at = np.arange(p.size - 1, n, far)
    stop = np.minimum(at + far, n)
    hits = []
    back = np.arange(p.block - 1, -1, -1)
    while len(at):
        shift = p.shifts[_slot(_poly(words[at[:, None] - back]))].astype(np.int64)
        hits.append(at[shift == 0])
        at = at + np.maximum(shift, 1)
        live = at < stop
        at, stop = at[live], stop[live]
    ends = np.sort(np.concatenate(hits))
    first = bound[np.searchsorted(bound, ends, side="right") - 1]
    ends = ends[ends - p.size + 1 >= first]  # windows lie in one document
    if not len(ends):
        return none, none
    whole = _poly(words[ends[:, None] - np.arange(p.size - 1, -1, -1)])
    which = np.minimum(np.searchsorted(p.hashes, whole), len(p.hashes) - 1)
    same = p.hashes[which] == whole
    return ends[same], which[same]


def searcher(patterns: Patterns):
    """work(flat, offsets, part) for map_text: words, hit words and items of each document, added to those of earlier passes."""
    import pyarrow as pa

    def work(flat, offsets, part):
        flat = _text.LOWER[flat]
        starts, ends, bound = _text.spans(flat, offsets, _text.ALNUM_OR_HIGH)
        words = _text.span_hashes(flat, starts, ends)
        hit = np.zeros(len(words) + 1, dtype=np.int32)
        items: dict[int, set] = {}
        raw = None
        for p in patterns.lengths:
            last, which = ends_found(words, bound, p)
            if not len(last):
                continue
            raw = raw if raw is not None else flat.tobytes()
            good = np.zeros(len(last), dtype=bool)
            docs = np.searchsorted(bound, last, side="right") - 1
            for i, (e, w, d) in enumerate(zip(last.tolist(), which.tolist(), docs.tolist())):
                span = range(e - p.size + 1, e + 1)
                own, h = [raw[starts[k] : ends[k]] for k in span], p.hashes[w]
                while w < len(p.hashes) and p.hashes[w] == h:
                    if own == patterns.text(int(p.first[w]), p.size):
                        good[i] = True
                        items.setdefault(d, set()).update(p.owners[p.ends[w] : p.ends[w + 1]].tolist())
                        break
                    w += 1
            np.add.at(hit, last[good] - p.size + 1, 1)
            np.add.at(hit, last[good] + 1, -1)
        covered = np.cumsum(hit[:-1]) > 0
        at = part.schema.get_field_index("hits")
        old_hits = part.column(at).to_pylist() if at >= 0 else [None] * part.num_rows
        old_items = part.column(part.schema.get_field_index("items")).to_pylist() if at >= 0 else [None] * part.num_rows
        total = np.concatenate([[0], np.cumsum(covered)])
        some = (total[bound[1:]] - total[bound[:-1]]) > 0
        hits, found = [], []
        for d in range(part.num_rows):
            own = np.flatnonzero(covered[bound[d] : bound[d + 1]]).tolist() if some[d] else []
            hits.append(sorted({*own, *old_hits[d]}) if old_hits[d] else own)
            ids = (patterns.items[x] for x in items.get(d, ()))
            found.append(sorted({*(str(x) for x in ids if x is not None), *(old_items[d] or ())}))
        return [np.diff(bound), pa.array(hits, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.string()))]

    return work


def scan(docs: DataFrame, items: DataFrame, text: str = "text", carry: list[str] = ("doc_id",), item: str = "item_id", item_text: str = "text", window: int = WINDOW, block: int = BLOCK, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``carry`` columns with n_words, hits (indexes of hit words) and items (ids as sorted strings) of every document.

    The item texts go to the tasks in passes of at most ``pass_bytes``; with more, each pass ends with a written table,
    and the next one reads the documents' words again and adds to the hits. Every pass is narrow, so nothing is shuffled
    however many documents share a passage, and one pass's patterns are held at a time.
    """
    spark = docs.sparkSession
    named = items.select(F.col(item).alias("item"), F.col(item_text).alias("words"))
    passes = max(1, -(-(named.agg(F.sum(F.octet_length("words"))).first()[0] or 0) // pass_bytes))
    found, before = docs.select(*carry, F.col(text).alias("__doc")), None
    for k in range(passes):
        own = named if passes == 1 else named.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == k)
        patterns = Patterns.build([tuple(r) for r in own.collect()], window, block)
        sent = spark.sparkContext.broadcast(patterns)
        keep = [*carry, *(["__doc"] if k < passes - 1 else [])]
        source = found if k == 0 else found.drop("n_words")
        found = _pass(source, keep, sent)
        if k < passes - 1:
            done = stored(found, "scanned")
            if k:
                drop_stored(before)
            found = before = done
            sent.destroy()
    return found


def _pass(source: DataFrame, keep: list[str], sent) -> DataFrame:
    both = [c for c in ("hits", "items") if c in source.columns]
    renamed = source
    if both:
        fields = "n_words bigint, new_hits array<int>, new_items array<string>"
        out = map_text(renamed, "__doc", [*keep, *both], fields, lambda: searcher(sent.value))
        return out.drop(*both).withColumnsRenamed({"new_hits": "hits", "new_items": "items"})
    return map_text(renamed, "__doc", keep, "n_words bigint, hits array<int>, items array<string>", lambda: searcher(sent.value))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", carry: list[str] = ("doc_id",), share: int = 20, **more) -> DataFrame:
    """``scan`` with n_hit, n_items, items_sha256 and contaminated: any word hit and ``share`` times the hits at least the words."""
    found = scan(docs, items, text, list(carry), **more)
    n_hit = F.size("hits").cast("long")
    return found.select(
        *carry,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )


def brute_force(docs: list[tuple], items: list[tuple], window: int = WINDOW, share: int = 20) -> list[tuple]:
    """The same by plain loops, for tests."""
    import re

    def words(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)

    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if (key := tuple(w[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[key]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and share * len(hit) >= len(w)))
    return out
