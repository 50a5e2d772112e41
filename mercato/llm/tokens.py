"""Token ids of whole texts, as pieces of documents or as flat binary files.

Ids come from the tokenizers library. Its byte-level tokenizers split a text before every
single space and around every single newline that stand between other characters; such a
piece is encoded once by the library's own pre-tokenizer and model and then looked up, in
a table of bounded size. Texts with any other white space, and other tokenizers, go
through the library as a whole.
"""

from __future__ import annotations

import json
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from mercato.llm.memory import given_back
from mercato.session import shared_dir, table

END_ID = 0
#: Pieces that one worker keeps; the table starts anew when it is full.
KEPT_PIECES = 1_000_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Odd(Exception):
    """A piece with white space that the table doesn't cover."""


class _Pieces(dict):
    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        word = piece.split()
        if len(word) == 1 and word[0] == piece:
            ids = self.encode(" " + piece)
        elif len(word) == 1 and piece == "\n" + word[0]:
            ids = self.encode("\n") + self.encode(word[0])
        else:
            raise _Odd
        if len(self) >= KEPT_PIECES:
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """encode(text): little-endian unsigned 32-bit ids of a text, without special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        state = json.loads(self.tok.to_str())
        pre, self.added = state["pre_tokenizer"] or {}, [x["content"] for x in state["added_tokens"]]
        self.model, self.pre = self.tok.model, self.tok.pre_tokenizer
        self.plain = not state["normalizer"] and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and state["model"]["type"] == "BPE" and not state["truncation"] and not state["padding"]
        self.pieces = _Pieces(self._part)
        self.space = self.pre.pre_tokenize_str(" a")[0][0][0] if self.plain else " "

        self.letters = {c: self.pre.pre_tokenize_str(chr(c))[0][0] for c in range(0x250) if chr(c).isalpha()} if self.plain else {}

    def _part(self, part: str) -> bytes:
        word = part[1:] if part[:1] == " " else part
        if self.letters and word.isalpha() and max(word) < "\u0250":  # one pre-token, known without a search
            parts = [(self.space if len(word) < len(part) else "") + word.translate(self.letters)]
        else:
            parts = [s for s, _ in self.pre.pre_tokenize_str(part)]
        return np.array([t.id for s in parts for t in self.model.tokenize(s)], "<u4").tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.plain or any(x in text for x in self.added):
            return self.whole(text)
        parts = text.replace("\n", " \n").split(" ")
        first = parts[0]
        if not first or first.split() != [first]:
            return self.whole(text)
        try:
            rest = b"".join(map(self.pieces.__getitem__, parts[1:]))
        except _Odd:
            return self.whole(text)
        return self._part(first) + rest


@lru_cache(4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, window: int = 1024, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents' ids, an end id last, cut at every `window` ids.

    (part, at: task and place in it, doc_id, start, length, ids_crc32, doc_tokens); a null
    text has the end id alone. One row per piece, repeated rows give repeated pieces.
    """
    path = path or default_tokenizer()
    end = np.array([END_ID], "<u4").tobytes()

    def work(batches):
        enc, part, at = encoder(path), TaskContext.get().partitionId(), 0
        try:
            for b in batches:
                rows = []
                for i, x in zip(b.column(0).to_pylist(), b.column(1)):
                    ids = enc.encode(x.as_py() or "") + end
                    n = len(ids) // 4
                    for s in range(0, n, window):
                        rows.append((part, at, i, s, min(window, n - s), zlib.crc32(ids[4 * s : 4 * (s + window)]), n))
                        at += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 7)], names=["part", "at", "doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        finally:
            enc.pieces.clear()  # the worker lives on, in stages that have no use for them

    some = docs.select(F.col(id_col).cast("long"), text_col)
    return some.mapInArrow(given_back(work), "part long, at long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def write_ids(docs: DataFrame, folder: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Write a token-id data set and return its manifest (also in manifest.json).

    Documents stand in ascending doc_id (null first, ties by text hash). Each part is
    `<name>.ids`, flat little-endian unsigned 16 or 32-bit ids, with `<name>.offsets`
    (unsigned 64-bit, one more than documents) and `<name>.docs` (signed 64-bit doc ids;
    the manifest counts the leading nulls). A part is written under a temporary name and
    moved when whole, so a task that runs again replaces it. Only part sizes reach the
    driver; their prefix sums are the parts' bases.
    """
    path = path or default_tokenizer()
    wide = encoder(path).tok.get_vocab_size() > 1 << 16
    kind = "<u4" if wide else "<u2"
    run = uuid.uuid4().hex[:8]
    root, base = pafs.FileSystem.from_uri(folder)
    root.create_dir(base, recursive=True)

    def work(batches):
        files, here = pafs.FileSystem.from_uri(folder)
        enc, part = encoder(path), TaskContext.get().partitionId()
        name, own = f"{run}-{part:06d}", uuid.uuid4().hex[:8]
        ends = ("ids", "offsets", "docs")
        outs = {e: files.open_output_stream(f"{here}/.{name}.{own}.{e}") for e in ends}
        outs["offsets"].write(np.zeros(1, "<u8").tobytes())
        docs_n = tokens = nulls = 0
        held: dict[str, list[bytes]] = {e: [] for e in ends}
        size = 0

        def flush() -> None:
            for e in ends:
                outs[e].write(b"".join(held[e]))
                held[e].clear()

        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(np.frombuffer(enc.encode(x.as_py() or ""), "<u4"), END_ID).astype(kind).tobytes()
                tokens += len(ids) // np.dtype(kind).itemsize
                docs_n += 1
                nulls += i is None
                held["ids"].append(ids)
                held["offsets"].append(tokens.to_bytes(8, "little"))
                held["docs"].append((i or 0).to_bytes(8, "little", signed=True))
                size += len(ids)
                if size > 4_000_000:
                    flush()
                    size = 0
        flush()
        for e in ends:
            outs[e].close()
            files.move(f"{here}/.{name}.{own}.{e}", f"{here}/{name}.{e}")
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (part, name, docs_n, tokens, nulls)], names=["part", "name", "docs", "tokens", "nulls"])

    tie = F.xxhash64(text_col)
    some = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"), tie.alias("h"))
    ranged = some.repartitionByRange("i", "h").sortWithinPartitions("i", "h").select("i", "t")
    parts = ranged.mapInArrow(work, "part long, name string, docs long, tokens long, nulls long").collect()
    manifest, start = {"version": 1, "dtype": kind, "tokenizer": path.rsplit("/", 1)[-1], "parts": []}, 0
    for p in sorted(parts):
        manifest["parts"].append(p.asDict() | {"base": start})
        start += p.tokens
    with root.open_output_stream(f"{base}/manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def read_part(folder: str, name: str, kind: str, what: str) -> np.ndarray:
    """A part's array: memory-mapped where the folder is a local one."""
    files, here = pafs.FileSystem.from_uri(folder)
    dtype = {"ids": kind, "offsets": "<u8", "docs": "<i8"}[what]
    where = f"{here}/{name}.{what}"
    if not files.get_file_info(where).size:
        return np.zeros(0, dtype)
    if isinstance(files, pafs.LocalFileSystem):
        return np.memmap(where, dtype, "r")
    with files.open_input_file(where) as f:
        return np.frombuffer(f.read(), dtype)


def read_ids(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files."""
    root, base = pafs.FileSystem.from_uri(folder)
    with root.open_input_stream(f"{base}/manifest.json") as f:
        manifest = json.loads(f.read())
    kind = manifest["dtype"]
    rows = [(p["name"], p["base"], p["nulls"]) for p in manifest["parts"] if p["docs"]]

    def work(batches):
        for b in batches:
            for name, start, nulls in zip(*(c.to_pylist() for c in b.columns)):
                ids, offsets, docs = (read_part(folder, name, kind, w) for w in ("ids", "offsets", "docs"))
                for at in range(0, len(docs), 4096):
                    o = offsets[at : at + 4097].astype(np.int64)
                    crc = [zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in zip(o, o[1:])]
                    own = pa.array(docs[at : at + 4096], mask=np.arange(at, at + len(crc)) < nulls)
                    yield pa.RecordBatch.from_arrays([own, pa.array(o[:-1] + start), pa.array(np.diff(o)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    frame = spark.createDataFrame(rows, "name string, base long, nulls long")
    return frame.repartition(max(1, len(rows))).mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_ids(spark, sf_dir: str) -> DataFrame:
    """Whole documents written as flat id files and read back."""
    folder = f"{shared_dir(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    write_ids(table(spark, sf_dir, "documents"), folder)
    return read_ids(spark, folder)
