"""Byte-level BPE: Spark higher-order functions fold ranked merges over the byte arrays of distinct words.

``merge`` is the fold. Its state is one array of longs, an element for each token: the rank of the pair it forms with its
right neighbour, its place in the word and its id, from high to low bits. So the smallest element is the leftmost pair
of lowest rank; each step replaces that pair and its left neighbour, until no pair has a rank. Ranks come from a literal
map, laid out as a perfect hash of pairs: one look at a bucket's displacement and one at the slot. A piece that is a
token itself is never split, as in the library that defines the format.

``encode`` counts words over all documents, folds those of the highest counts once (``hot`` at most), and gives them to
the tasks as a dictionary of bounded size. Words outside it are folded where they occur, once in each task: the task's
two Python ends see the same rows in the same order, so the first sends a rare word once and the second keeps its ids.
Dictionary and memory only save time: results do not depend on them. Nothing but the word counts is shuffled.

A fold moves a word's whole state at each merge, so its time grows with the square of the length. Words of more than
LONG bytes, such as unbroken base64, are merged by a heap of ranked pairs in the Python end instead.

Words are the matches of the splitting pattern ``public_tokenizers.PATTERN``, found by class runs over code points.

Defined results: a null text is empty, has no ids and decodes to no bytes. Repeated rows give repeated results. Extra
columns are ignored; an empty table gives an empty table. Texts must be valid UTF-8, as Spark strings are. ``decode``
rejects ids outside the vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import unicodedata

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _text
from ._common import drop_stored, ship, stored

#: Words in the dictionary of frequent words.
HOT = 1 << 20
#: Words that a task remembers before it starts anew.
REMEMBERED = 1 << 19
#: Bytes of a word beyond which it is merged by a heap.
LONG = 512
#: Text between two Python ends at once.
STEP_BYTES = 1 << 19
#: Ids are 16 bits of the state; the largest stands for the ends of a word, which no pair has.
END = (1 << 16) - 1
#: The rank of no pair, and the lowest bit of ranks and of places in an element of the state.
NO_RANK, RANK_BIT, PLACE_BIT = 1 << 16, 46, 16
#: Displacements of a bucket are below this.
REACH = 1 << 12
_LETTER, _NUMBER, _SPACE = 1, 2, 3
#: Code points of white space (fixed values of the Unicode property).
_BLANKS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

_classes: list[np.ndarray] = []


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def classes() -> np.ndarray:
    """Class of each code point: letter, number, white space or 0."""
    if not _classes:
        kind = np.zeros(0x110000, dtype=np.uint8)
        for c in range(0x110000):
            first = unicodedata.category(chr(c))[0]
            if first in "LN":
                kind[c] = _LETTER if first == "L" else _NUMBER
        kind[_BLANKS] = _SPACE
        _classes.append(kind)
    return _classes[0]


def words(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where words start, with the end of the text last, and the first word of each document."""
    if not len(flat):
        return np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
    points = np.frombuffer(flat.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    at = np.flatnonzero((flat & 0xC0) != 0x80)  # the first byte of each code point
    n = len(points)
    kind = classes()[points]
    doc = np.zeros(n + 1, dtype=bool)
    doc[np.searchsorted(at, offsets)] = True
    run = doc.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    begin = run[:n].copy()
    # white space: its last character stands alone or, being a blank, opens the next word
    last = np.flatnonzero((kind == _SPACE) & run[1:] & ~doc[1:])
    begin[last] = True
    begin[last[points[last] == 0x20] + 1] = False
    # contractions: an apostrophe that begins a word takes one or two letters
    mark = np.flatnonzero((points == 0x27) & begin & run[1:] & ~doc[1:])
    one = points[mark + 1]
    inside = (mark + 2 < n) & ~doc[np.minimum(mark + 2, n)]
    two = np.where(inside, points[np.minimum(mark + 2, n - 1)], 0)
    letters = np.zeros(len(mark), dtype=np.int64)
    letters[np.isin(one, [ord(c) for c in "stmd"])] = 1
    for pair in ("re", "ve", "ll"):
        letters[(one == ord(pair[0])) & (two == ord(pair[1]))] = 2
    mark, letters = mark[letters > 0], letters[letters > 0]
    begin[mark + 1] = False
    after = mark + 1 + letters
    begin[after[after < n]] = True
    starts = np.append(at[begin], len(flat))
    return starts, np.searchsorted(starts[:-1], offsets)


def _prime(least: int) -> int:
    n = max(3, least | 1)
    while any(n % k == 0 for k in range(3, int(n**0.5) + 1, 2)):
        n += 2
    return n


def _perfect(keys: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray]:
    """(buckets, slots, displacement of each bucket, key index of each slot or -1): a perfect hash of distinct keys.

    A key's slot is key % slots + displacement[key % buckets]; buckets are placed largest first at the first free place.
    """
    buckets, slots = _prime(len(keys) // 4), _prime(2 * len(keys) + 1)
    while len(np.unique(keys % buckets * slots + keys % slots)) < len(keys):
        slots = _prime(slots + 2)
    order = np.argsort(keys % buckets, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(keys % buckets, minlength=buckets))])
    moved, filled = np.zeros(buckets, dtype=np.int64), np.full(slots + REACH, -1)
    window = np.lib.stride_tricks.sliding_window_view(filled, REACH)
    for bucket in np.argsort(-np.diff(bounds), kind="stable"):
        own = order[bounds[bucket] : bounds[bucket + 1]]
        if not len(own):
            break
        free = np.flatnonzero((window[keys[own] % slots] < 0).all(axis=0))
        if not len(free):
            raise ValueError("the pairs of the vocabulary do not fit the table")
        moved[bucket] = free[0]
        filled[keys[own] % slots + free[0]] = own
    return buckets, slots, moved, filled


class Vocabulary:
    """Ranks by bytes, with the literal pair map for Spark."""

    def __init__(self, path: str):
        ranks = load_ranks(path)
        if max(ranks.values()) >= END:
            raise ValueError("the vocabulary is too large for 16-bit ids")
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.bytes = [ranks[bytes([b])] for b in range(256)]
        pairs = {}
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 16 | right] = rank
        keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
        values = (keys << 16 | np.fromiter(pairs.values(), dtype=np.int64, count=len(pairs))).tolist()
        self.buckets, self.slots, moved, filled = _perfect(keys)
        table = {"moved": moved.tolist(), "slots": [values[i] if i >= 0 else None for i in filled.tolist()], "bytes": self.bytes}
        self._literal = json.dumps(table, separators=(",", ":"))

    def merge(self, words: Column) -> Column:
        """Token ids of each of an array of words, which are arrays of byte values; the literal map stands in it once."""
        table = F.from_json(F.lit(self._literal), "moved array<int>, slots array<bigint>, bytes array<int>")
        return F.element_at(F.transform(F.array(table), lambda t: F.transform(words, lambda w: self._fold(t, w))), 1)

    def _fold(self, table: Column, word: Column) -> Column:
        def long(n: int) -> Column:
            return F.lit(n).cast("long")

        def ranked(low: Column, key: Column) -> Column:
            """An element with the rank of its pair: a slot holds its key above the rank, so a foreign slot is too large."""
            slot = (key % self.slots + F.get(table["moved"], (key % self.buckets).cast("int"))).cast("int")
            rank = F.least(F.get(table["slots"], slot).bitwiseXOR(F.shiftleft(key, 16)), long(NO_RANK))
            return low.bitwiseOR(F.shiftleft(rank, RANK_BIT))

        places = long((1 << RANK_BIT) - 1)

        def bound(value: Column, then) -> Column:
            return F.element_at(F.transform(F.array(value), then), 1)  # get derives its type anew for each row

        def step(state: Column, _: Column) -> Column:
            def merged(lowest: Column) -> Column:
                new = F.shiftright(lowest, RANK_BIT)

                def at(i: Column) -> Column:
                    before, behind = F.get(state, i - 2), F.get(state, i + 1)
                    lows = F.array(before.bitwiseAND(places), lowest.bitwiseAND(long((1 << RANK_BIT) - (1 << PLACE_BIT))).bitwiseOR(new))
                    keys = F.array(F.shiftleft(before.bitwiseAND(long(END)), 16).bitwiseOR(new), F.shiftleft(new, 16).bitwiseOR(behind.bitwiseAND(long(END))))
                    return F.flatten(F.array(F.slice(state, F.lit(1), i - 2), F.zip_with(lows, keys, ranked), F.slice(state, i + 2, F.size(state))))

                # elements are in the order of their places; array_position is slow where it is interpreted
                ahead = F.filter(state, lambda x: x.bitwiseAND(places) < lowest.bitwiseAND(places))
                return F.when(lowest >= long(NO_RANK << RANK_BIT), state).otherwise(bound(F.size(ahead) + 1, at))

            return bound(F.array_min(state), merged)

        ids = F.transform(word, lambda b: F.get(table["bytes"], b).cast("long"))
        end = F.array(long(END))
        pairs = F.zip_with(F.concat(end, ids, end), F.concat(ids, end, end), lambda l, r: ranked(l, F.shiftleft(l, 16).bitwiseOR(r)))
        start = F.transform(pairs, lambda x, i: x.bitwiseOR(F.shiftleft(i.cast("long"), PLACE_BIT)))
        done = lambda state: F.transform(F.slice(state, F.lit(2), F.size(state) - 2), lambda x: x.bitwiseAND(long(END)).cast("int"))
        return F.aggregate(F.array_repeat(F.lit(0), F.greatest(F.size(word) - 1, F.lit(0))), start, step, done)


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of a word by a heap of ranked pairs, the leftmost of equal ranks first."""
    n = len(word)
    ends, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

    def rank_at(i: int):
        j = ends[i]
        return ranks.get(word[i : ends[j]]) if j < n else None

    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i, stop = heapq.heappop(heap)
        if not alive[i] or ends[i] >= n or ends[ends[i]] != stop:
            continue
        alive[ends[i]] = False
        ends[i] = stop
        if stop < n:
            before[stop] = i
        for k in (i, before[i]):
            if k >= 0 and (found := rank_at(k)) is not None:
                heapq.heappush(heap, (found, k, ends[ends[k]]))
    return [ranks[word[i : ends[i]]] for i in range(n) if alive[i]]


class Dictionary:
    """Word hashes with their ids, sorted by hash."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, ids: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        where, self.ends = _text.ragged(np.concatenate([[0], np.cumsum(counts)]), order)
        self.hashes, self.ids = hashes[order], ids[where].astype(np.uint16)

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


def _hash_words(flat: np.ndarray, starts: np.ndarray):
    return np.unique(_text.span_hashes(flat, starts[:-1], starts[1:]), return_index=True, return_inverse=True, return_counts=True)


def word_counts(docs: DataFrame, text: str, known: np.ndarray) -> DataFrame:
    """(word, n): words that a task meets twice, but for those of the sorted hashes ``known``, with their counts."""
    import pyarrow as pa

    ship(docs.sparkSession)
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches):
        seen: dict[int, int] = {}
        repeated: dict[int, bytes] = {}

        def rows():
            own = list(repeated)
            for low in range(0, len(own), 1 << 15):
                part = own[low : low + (1 << 15)]
                yield pa.RecordBatch.from_arrays([pa.array([repeated[h] for h in part], pa.binary()), pa.array([seen[h] for h in part], pa.int64())], schema=schema)

        for batch in batches:
            for _, flat, offsets in _text.steps(batch, "text", STEP_BYTES):
                starts, _ = words(flat, offsets)
                hashes, first, _, counts = _hash_words(flat, starts)
                few = np.flatnonzero(~np.isin(hashes, known) & (np.diff(starts)[first] <= LONG))
                raw, at = flat.tobytes(), first[few]
                for h, n, a, z in zip(hashes[few].tolist(), counts[few].tolist(), starts[at].tolist(), starts[at + 1].tolist()):
                    n += seen.get(h, 0)
                    seen[h] = n
                    if n > 1 and h not in repeated:
                        repeated[h] = raw[a:z]
                if len(seen) > REMEMBERED // 2:  # with their bytes and counts
                    yield from rows()
                    seen, repeated = {}, {}
        yield from rows()

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "word binary, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def dictionary(docs: DataFrame, vocabulary: Vocabulary, text: str, hot: int) -> Dictionary:
    """The tokens of the vocabulary themselves and at most ``hot`` other words of ``docs``, the most frequent, folded by
    Spark. Words are taken down to a class of counts (eighths of a power of two) that still fits as a whole."""
    flat = np.frombuffer(b"".join(vocabulary.pieces), dtype=np.uint8)
    ends = np.concatenate([[0], np.cumsum([len(p) for p in vocabulary.pieces])])
    own = np.flatnonzero(np.diff(ends))
    hashes = _text.span_hashes(flat, ends[:-1][own], ends[1:][own])
    counts, ids = np.ones(len(own), dtype=np.int64), own
    if hot:
        level = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
        counted = stored(word_counts(docs, text, np.sort(hashes)).withColumn("level", level), "words")
        least, total = None, 0
        for row in counted.groupBy("level").count().orderBy(F.desc("level")).collect():  # at most 8 * 63 levels
            total += row["count"]
            if total > hot:
                break
            least = row["level"]
        if least is not None:
            latin = F.decode("word", "ISO-8859-1")
            values = F.transform(F.sequence(F.lit(1), F.octet_length("word")), lambda i: F.ascii(F.substring(latin, i, F.lit(1))))
            top = counted.where(F.col("level") >= least).select("word", values.alias("bytes")).repartition(docs.sparkSession.sparkContext.defaultParallelism)
            more = top.select("word", F.get(vocabulary.merge(F.array("bytes")), 0).alias("ids")).toArrow().combine_chunks()
            if more.num_rows:
                word, lists = more.column("word").chunk(0), more.column("ids").chunk(0)
                raw, bound = np.frombuffer(word.buffers()[2], dtype=np.uint8), np.frombuffer(word.buffers()[1], dtype=np.int32)[: len(word) + 1].astype(np.int64)
                hashes = np.concatenate([hashes, *[_text.span_hashes(raw[bound[i] : bound[j]], bound[i:j] - bound[i], bound[i + 1 : j + 1] - bound[i]) for i, j in _ranges(len(word), 1 << 16)]])
                counts = np.concatenate([counts, np.diff(lists.offsets.to_numpy())])
                ids = np.concatenate([ids, lists.flatten().to_numpy()])
        drop_stored(counted)
    return Dictionary(hashes, counts, ids)


def _ranges(n: int, size: int):
    return [(i, min(i + size, n)) for i in range(0, n, size)]


def _steps(docs: DataFrame, id_col: str, text: str, sent, pieces) -> DataFrame:
    """A row for each step of documents: ids, word rows (negative: into the task's rare words), the byte values of new
    rare words, and the ids of those that are too long for the fold; ``anew`` where the task's rare words start again."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id_col].dataType
    lists = pa.list_(pa.list_(pa.int32()))
    schema = pa.schema([("ids", pa.list_(to_arrow_type(kind))), ("rows", pa.binary()), ("bounds", pa.binary()), ("anew", pa.bool_()), ("rare", lists), ("long", lists)])

    def run(batches):
        hot, ranks = sent.value, {}
        seen: dict[int, int] = {}
        for batch in batches:
            for part, flat, offsets in _text.steps(batch, "text", STEP_BYTES):
                starts, bound = words(flat, offsets)
                hashes, first, which, _ = _hash_words(flat, starts)
                rows = hot.rows(hashes)
                rare = np.flatnonzero(rows < 0)
                if len(seen) > REMEMBERED:
                    seen.clear()
                anew, new = not seen, []
                for i, h in zip(rare.tolist(), hashes[rare].tolist()):
                    if h not in seen:
                        seen[h] = -1
                        new.append(i)
                at = first[new] if new else np.zeros(0, np.int64)
                long = np.flatnonzero(starts[at + 1] - starts[at] > LONG)
                short = np.delete(at, long)
                made = []
                if len(long) and not ranks:
                    ranks = {p: i for i, p in enumerate(pieces.value) if p}
                for i in long.tolist():
                    made.append(merge_long(flat[starts[at[i]] : starts[at[i] + 1]].tobytes(), ranks))
                order = np.concatenate([np.delete(np.arange(len(at)), long), long]).astype(np.int64)  # short words first
                base = 0 if anew else len(seen) - len(new)
                for n, k in enumerate(order.tolist()):
                    seen[int(hashes[new[k]])] = base + n
                rows[rare] = [-1 - seen[h] for h in hashes[rare].tolist()]
                where, ends = _text.ragged(starts, short) if len(short) else (np.zeros(0, np.int64), np.zeros(1, np.int64))
                inner = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat[where].astype(np.int32)))
                one = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x).cast(t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column(0).to_pylist()], schema.field(0).type), pa.array([rows[which].astype(np.int32).tobytes()], pa.binary()), pa.array([bound.astype(np.int64).tobytes()], pa.binary()), pa.array([anew]), one(inner, lists), one(pa.array(made, lists.value_type), lists)],
                    schema=schema,
                )

    ddl = f"ids array<{kind.simpleString()}>, rows binary, bounds binary, anew boolean, rare array<array<int>>, long array<array<int>>"
    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(run, ddl)


class _Rare:
    """The ids of a task's rare words, in arrays that grow by doubling."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.rows, self.ends, self.ids = 0, np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.int32)

    def add(self, counts: np.ndarray, ids: np.ndarray):
        last = self.ends[self.rows]
        while self.rows + len(counts) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while last + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ends[self.rows + 1 : self.rows + 1 + len(counts)] = last + np.cumsum(counts)
        self.ids[last : last + len(ids)] = ids
        self.rows += len(counts)


def _gather(hot: Dictionary, rare: _Rare, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a sequence of words and the place where each word's ids end."""
    is_rare = rows < 0
    row = np.where(is_rare, -1 - rows, rows)
    begin, counts = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    for own, ends in ((~is_rare, hot.ends), (is_rare, rare.ends)):
        begin[own] = ends[row[own]]
        counts[own] = ends[row[own] + 1] - begin[own]
    stop = np.concatenate([[0], np.cumsum(counts)])
    where = np.repeat(begin - stop[:-1], counts) + np.arange(stop[-1])
    from_rare = np.repeat(is_rare, counts)
    ids = np.empty(stop[-1], dtype=np.int32)
    ids[~from_rare] = hot.ids[where[~from_rare]]
    ids[from_rare] = rare.ids[where[from_rare]]
    return ids, stop


def tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", hot: int = HOT, with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """Each document encoded and decoded again: (doc_id, n_tokens, ids_sha256, decoded_sha256[, ids][, decoded])."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    vocabulary = Vocabulary(path)
    sent = spark.sparkContext.broadcast(dictionary(docs, vocabulary, text, hot))
    pieces = spark.sparkContext.broadcast(vocabulary.pieces)
    made = _steps(docs, id_col, text, sent, pieces).select("ids", "rows", "bounds", "anew", vocabulary.merge(F.col("rare")).alias("rare"), "long")
    kind = docs.schema[id_col].dataType
    ddl = f"doc_id {kind.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids + ", decoded binary" * with_text
    arrow = to_arrow_type(kind)

    def run(batches):
        hot_words, decode, rare = sent.value, Decoder(pieces.value), _Rare()
        for batch in batches:
            for i in range(batch.num_rows):
                docs_of = batch.column(0)[i].values
                rows = np.frombuffer(batch.column(1)[i].as_py(), dtype=np.int32).astype(np.int64)
                bounds = np.frombuffer(batch.column(2)[i].as_py(), dtype=np.int64)
                if batch.column(3)[i].as_py():
                    rare.clear()
                for column in (4, 5):
                    new = batch.column(column)[i].values
                    rare.add(np.diff(new.offsets.to_numpy()), new.flatten().to_numpy())
                ids, by_word = _gather(hot_words, rare, rows)
                at = by_word[bounds]
                columns = [docs_of.cast(arrow), pa.array(np.diff(at)), pa.array(decode.ids_digests(ids, at)), pa.array(decode.text_digests(ids, at))]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                if with_text:
                    columns.append(pa.array(decode.texts(ids, at), pa.binary()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)

    return made.mapInArrow(run, ddl)


class Decoder:
    """Concatenates the binary pieces of ids; digests of ids and of decoded bytes."""

    def __init__(self, pieces: list[bytes]):
        self.flat, self.ends = self._table(pieces)
        self.digits, self.digit_ends = self._table([b"%d," % i for i in range(len(pieces))])

    @staticmethod
    def _table(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(parts), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _cut(self, flat, ends, ids, at) -> list[bytes]:
        where, by_id = _text.ragged(ends, ids.astype(np.int64))
        raw, by_doc = flat[where].tobytes(), by_id[at]
        return [raw[by_doc[d] : by_doc[d + 1]] for d in range(len(at) - 1)]

    def texts(self, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.ends) - 1):
            raise ValueError("an id is outside the vocabulary")
        return self._cut(self.flat, self.ends, ids, at)

    def text_digests(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        return [hashlib.sha256(x).hexdigest() for x in self.texts(ids, at)]

    def ids_digests(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        return [hashlib.sha256(x[:-1]).hexdigest() for x in self._cut(self.digits, self.digit_ends, ids, at)]


def decode(ids: Column, path: str) -> Column:
    """Binary text of an array of ids, by Spark alone: the pieces joined byte for byte."""
    vocabulary = load_ranks(path)
    pieces = [""] * (max(vocabulary.values()) + 1)
    for piece, rank in vocabulary.items():
        pieces[rank] = piece.decode("latin-1")
    table = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    return F.encode(F.array_join(F.transform(ids, lambda i: F.element_at(table, i + 1)), ""), "ISO-8859-1")
