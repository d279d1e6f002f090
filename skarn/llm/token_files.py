"""Token ids as flat unsigned integer files with 64-bit document offsets, written by many tasks and read by memory map.

A data set is a folder of parts. Part ``k`` holds the documents of one range of ids, in ascending order:

* ``part-k.tokens``   flat little-endian unsigned integers, two bytes wide where the vocabulary allows, else four
* ``part-k.offsets``  unsigned 64-bit, documents + 1 values, in tokens from the part's start
* ``part-k.ids``      signed 64-bit document ids

``bases`` are the prefix sums of the parts' token counts, so a document's place in the whole is base + offset. Only one
row for each part reaches the driver. A task writes under a name of its own attempt and then renames, so a repeated or
lost task leaves the same files.

Encoding calls the tokenizers library once for each distinct piece that a worker meets; pieces end at ASCII white space
and between an ASCII letter or digit and ASCII punctuation other than the apostrophe, where neither the normaliser nor
the splitting pattern of the vocabulary looks across. For vocabularies that do look across, pass ``pieces=False``.

With ``added``, the literal of an added token in a text is that token, as by the library's default, and a text that holds
the first two characters of one is encoded whole; without it, such literals are ordinary text.

Defined results: a null text is empty and holds the end id alone. Repeated ids stay separate documents, ordered by their
text. Rows with a null id come first. An empty table makes an empty data set. Extra columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text
from ._common import new_path, qualified, ship

PART_BYTES = 32 << 20
#: Distinct pieces that a worker remembers before it starts anew.
REMEMBERED = 1 << 20

_ALNUM = _text.table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
_PUNCTUATION = _text.table((0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_encoders: dict[tuple, Encoder] = {}


class Encoder:
    """Encodes steps of documents with a tokenizers file, remembering pieces."""

    def __init__(self, path: str, pieces: bool = True, added: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.pieces = pieces
        self.signs = {t.content[:2].lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()} if added and pieces else set()
        self._clear()

    def _clear(self):
        self.row: dict[int, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.ends = np.zeros(1 << 14, dtype=np.int64)  # ends[i + 1]: end of row i
        self.rows = 0

    def _add(self, texts: list[str]):
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        start, total = self.ends[self.rows], int(counts.sum())
        while self.rows + len(ids) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while start + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.ends[self.rows + 1 : self.rows + 1 + len(ids)] = start + np.cumsum(counts)
        self.flat[start : start + total] = [i for x in ids for i in x]
        self.rows += len(ids)

    def __call__(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents and their offsets."""
        low = flat.tobytes().lower() if self.signs else b""
        if not any(x in low for x in self.signs):
            return self._encoded(flat, offsets)
        out, counts = [], []
        for d in range(len(offsets) - 1):
            a, b = int(offsets[d]), int(offsets[d + 1])
            if any(x in low[a:b] for x in self.signs):
                text = flat[a:b].tobytes().decode()
                ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
            else:
                ids, _ = self._encoded(flat[a:b], np.array([0, b - a]))
            out.append(ids)
            counts.append(len(ids))
        return np.concatenate(out), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def _encoded(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not self.pieces:
            raw = flat.tobytes()
            self._clear()
            self._add([raw[offsets[d] : offsets[d + 1]].decode() for d in range(len(offsets) - 1)])
            return self.flat[: self.ends[self.rows]].copy(), self.ends[: self.rows + 1].copy()
        cut = np.zeros(len(flat), dtype=bool)
        alnum, mark = _ALNUM[flat], _PUNCTUATION[flat]
        cut[1:] = (alnum[:-1] & mark[1:]) | (mark[:-1] & alnum[1:])
        starts, ends, bound = _text.spans(flat, offsets, _text.NOT_BLANK, cut)
        hashes, first, which = np.unique(_text.span_hashes(flat, starts, ends), return_index=True, return_inverse=True)
        if self.rows > REMEMBERED:
            self._clear()
        known = self.row
        rows = [known.get(h, -1) for h in hashes.tolist()]
        if new := [i for i, r in enumerate(rows) if r < 0]:
            raw = flat.tobytes()
            at = self.rows
            self._add([raw[starts[first[i]] : ends[first[i]]].decode() for i in new])
            for n, i in enumerate(new):
                rows[i] = known[int(hashes[i])] = at + n
        where, by_piece = _text.ragged(self.ends[: self.rows + 1], np.array(rows, dtype=np.int64)[which])
        return self.flat[where], by_piece[bound]


def encoder(path: str, pieces: bool = True, added: bool = False) -> Encoder:
    if (path, pieces, added) not in _encoders:
        _encoders[path, pieces, added] = Encoder(path, pieces, added)
    return _encoders[path, pieces, added]


def _put(fs, path: str, data: bytes) -> None:
    part = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        out.write(data)
    fs.move(part, path)


def write(docs: DataFrame, tokenizer: str, end_id: int | None, path: str | None = None, id_col: str = "doc_id", text: str = "text", vocabulary: int = 1 << 16, part_bytes: int = PART_BYTES, pieces: bool = True, added: bool = False) -> tuple[str, list[dict]]:
    """Write a data set; returns its folder and its parts in order, each {part, documents, tokens, base, width, nulls}:
    the first ``nulls`` documents of a part have no id."""
    from pyarrow.fs import FileSystem

    spark = docs.sparkSession
    ship(spark)
    path = qualified(spark, path or new_path(spark, "tokens"))
    width = 2 if vocabulary <= 1 << 16 else 4
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = max(1, -(-(picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // part_bytes))
    # ranges of ids by Spark's sample, one to a task: a part is a partition, and nulls sort first
    dealt = picked.repartitionByRange(parts, "id").sortWithinPartitions("id", "text").withColumn("part", F.spark_partition_id())
    kind = np.dtype(f"<u{width}")
    schema = pa.schema([("part", pa.int32()), ("documents", pa.int64()), ("tokens", pa.int64()), ("nulls", pa.int64())])

    def run(batches):
        encode = encoder(tokenizer, pieces, added)
        fs, top = FileSystem.from_uri(path)
        fs.create_dir(top, recursive=True)
        now, out, name, ids, counts, nulls = None, None, "", [], [], 0

        def close():
            out.close()
            count = np.concatenate([np.zeros(0, np.int64), *counts])
            _put(fs, f"{top}/part-{now:05d}.offsets", np.concatenate([[0], np.cumsum(count)]).astype("<u8").tobytes())
            _put(fs, f"{top}/part-{now:05d}.ids", np.concatenate([np.zeros(0, np.int64), *ids]).astype("<i8").tobytes())
            fs.move(name, f"{top}/part-{now:05d}.tokens")
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([len(count)], pa.int64()), pa.array([int(count.sum())], pa.int64()), pa.array([nulls], pa.int64())], schema=schema)

        for batch in batches:
            which = batch.column(2).to_numpy()
            for group in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(which)) + 1):
                if not len(group):
                    continue
                own = batch.slice(int(group[0]), len(group))
                if which[group[0]] != now:
                    if out is not None:
                        yield close()
                    now, ids, counts, nulls = int(which[group[0]]), [], [], 0
                    name = f"{top}/part-{now:05d}.tokens.{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}"
                    out = fs.open_output_stream(name)
                for step, flat, offsets in _text.steps(own, "text"):
                    tokens, at = encode(flat, offsets)
                    if end_id is not None:
                        tokens = np.insert(tokens, at[1:], end_id)
                        at = at + np.arange(len(at))
                    if len(tokens) and int(tokens.max()) >= 1 << 8 * width:
                        raise ValueError(f"an id does not fit {width} bytes: give the size of the vocabulary")
                    out.write(tokens.astype(kind).tobytes())
                    counts.append(np.diff(at))
                    nulls += step.column(0).null_count
                    ids.append(step.column(0).fill_null(0).to_numpy())
        if out is not None:
            yield close()

    made = sorted(dealt.select("id", "text", "part").mapInArrow(run, "part int, documents bigint, tokens bigint, nulls bigint").collect())
    bases = np.concatenate([[0], np.cumsum([r.tokens for r in made])]).tolist()
    return path, [{"part": r.part, "documents": r.documents, "tokens": r.tokens, "base": bases[i], "width": width, "nulls": r.nulls} for i, r in enumerate(made)]


def _open(fs, path: str, kind: str) -> np.ndarray:
    """Memory map where the file is local, else its bytes."""
    from pyarrow.fs import LocalFileSystem

    if not fs.get_file_info(path).size:
        return np.zeros(0, dtype=kind)
    if isinstance(fs, LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=kind)


def read(spark: SparkSession, path: str, parts: list[dict], with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document from the files; ``with_ids`` adds the ids themselves."""
    from pyarrow.fs import FileSystem

    ship(spark)
    fields = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    if not parts:
        return spark.createDataFrame([], fields)
    listed = spark.createDataFrame([(p["part"], p["base"], p["width"], p["nulls"]) for p in parts], "part int, base bigint, width int, nulls bigint").repartition(len(parts))

    def run(batches):
        fs, top = FileSystem.from_uri(path)
        for batch in batches:
            for p in batch.to_pylist():
                stem = f"{top}/part-{p['part']:05d}"
                tokens, at, ids = _open(fs, stem + ".tokens", f"<u{p['width']}"), _open(fs, stem + ".offsets", "<u8").astype(np.int64), _open(fs, stem + ".ids", "<i8")
                for low in range(0, len(ids), 4096):
                    high = min(low + 4096, len(ids))
                    own = [tokens[at[d] : at[d + 1]].astype("<u4") for d in range(low, high)]
                    columns = [
                        pa.array(ids[low:high].astype(np.int64), mask=np.arange(low, high) < p["nulls"]),
                        pa.array(p["base"] + at[low:high]),
                        pa.array(np.diff(at[low : high + 1])),
                        pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()),
                    ]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.array([x.tolist() for x in own], pa.list_(pa.int64())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)

    return listed.mapInArrow(run, fields)
