"""Operator 2: byte-level BPE encoding and decoding by prefix dynamic programming (see :mod:`prefix_bpe`).

The rank file is read once on the driver (its path is a parameter) and its
tables go to the executors as a broadcast of fixed size (one vocabulary). Each
task encodes its own rows: no shuffle, and nothing depends on other rows.

Cases: null text counts as empty (no ids, empty bytes); empty tables give an
empty result; repeated rows are encoded each; the input's own columns are kept
and the new ones come last (a column of the same name is replaced).
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoframe.llm.memories import held, trim
from chronoframe.llm.prefix_bpe import REMEMBER, MergeTable
from chronoframe.llm.storage import document_batches


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PieceEncoder(dict):
    """Piece (str) to its packed little-endian ids; a bounded memory of pieces already encoded."""

    def __init__(self, ranks: dict[bytes, int], remember: int = REMEMBER):
        self.ranks, self.remember = ranks, remember
        self.table = MergeTable(ranks, remember=remember)

    def ids(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.table.encode(piece)

    def __missing__(self, piece: str) -> bytes:
        ids = self.ids(piece.encode("utf-8"))
        if len(self) >= self.remember:
            self.clear()
        out = self[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return out


class EditableText:
    """A text with its pieces and their prefix tables: exact appends, and re-encoding near edits only."""

    def __init__(self, encoder: PieceEncoder, pattern, text: str = ""):
        self.encoder, self.pattern = encoder, pattern
        self.text, self.pieces = text, [(m.start(), m[0]) for m in pattern.finditer(text)]

    def ids(self) -> list[int]:
        return [i for _, p in self.pieces for i in struct.unpack(f"<{len(self.encoder[p]) // 4}I", self.encoder[p])]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Splits anew from the piece that the edit or the pattern's look-ahead may reach until a border matches an old one."""
        text = self.text[:start] + new + self.text[end:]
        shift = len(new) - (end - start)
        keep = [x for x in self.pieces if x[0] + len(x[1]) <= start - 3]
        if keep and len(keep) < len(self.pieces):
            keep = keep[:-1]
        at = keep[-1][0] + len(keep[-1][1]) if keep else 0
        old = {p + shift: k for k, (p, _) in enumerate(self.pieces) if p >= end}
        out = keep
        while at < len(text):
            if at >= start + len(new) and at in old:
                out = out + [(p + shift, s) for p, s in self.pieces[old[at]:]]
                break
            m = self.pattern.match(text, at)
            if m is None:
                at += 1
                continue
            out.append((at, m[0]))
            at = m.end()
        self.text, self.pieces = text, out


def _local(shared, pattern: str):
    """The worker's tables: built once for a broadcast, kept while the worker lives."""
    import regex

    return held((shared.value["key"], pattern), lambda: (shared.value["encoder"], regex.compile(pattern)))


def _share(spark: SparkSession, path: str, remember: int = REMEMBER):
    encoder = PieceEncoder(read_ranks(path), remember)
    return spark.sparkContext.broadcast({"key": (path, remember), "encoder": encoder})


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", keep_ids: bool = True, remember: int = REMEMBER) -> DataFrame:
    """Add ``token_ids`` (array, left out if ``keep_ids`` is false), ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    ``decoded_sha256`` is taken from the bytes that decoding the ids gives back.
    ``remember`` bounds the pieces that a worker keeps (some hundred bytes each).
    """
    added = ["token_ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    rest = [c for c in df.columns if c not in added]
    shared = _share(document_batches(df).sparkSession, path, remember)

    def run(batches):
        import numpy as np

        encoder, rx = _local(shared, pattern)
        bytes_of = encoder.table.text
        for batch in batches:
            counts, packed, id_sha, text_sha = [], [], [], []
            for text in batch.column(batch.schema.get_field_index(text_col)).to_pylist():
                s = text or ""
                raw = b"".join(map(encoder.__getitem__, rx.findall(s)))
                ids = np.frombuffer(raw, dtype="<u4").tolist()
                counts.append(len(ids))
                id_sha.append(hashlib.sha256(raw).hexdigest())
                text_sha.append(hashlib.sha256(b"".join(map(bytes_of.__getitem__, ids))).hexdigest())
                if keep_ids:
                    packed.append(raw)
            cols = {c: batch.column(batch.schema.get_field_index(c)) for c in rest}
            if keep_ids:
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                cols["token_ids"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)))
            cols |= {"n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(id_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
            yield pa.RecordBatch.from_pydict(cols)
            trim()               # the batch's strings leave holes between the remembered pieces

    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest]
    kinds += ["token_ids array<int>"] * keep_ids + ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
    return df.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, ", ".join(kinds))


def decode(df: DataFrame, path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """Add the bytes of each row's ids as ``out_col`` (binary); null ids give empty bytes."""
    rest = [c for c in df.columns if c != out_col]
    shared = _share(df.sparkSession, path)

    def run(batches):
        encoder, _ = _local(shared, "")
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            cols = {c: batch.column(batch.schema.get_field_index(c)) for c in rest}
            cols[out_col] = pa.array([b"".join(encoder.table.text[i] for i in x or ()) for x in ids], pa.binary())
            yield pa.RecordBatch.from_pydict(cols)

    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest] + [f"`{out_col}` binary"]
    return df.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, ", ".join(kinds))
