"""Packing: concatenate and cut.

Pass one encodes each document once and writes its ids with the running token count inside its partition (a table in
the shared folder: later reads need no recomputation, and a lost executor costs one partition). Partition totals, one
number a partition, are summed up to each partition's base. Pass two adds base and local start, which gives every
document its global offset, and cuts at multiples of the window: a piece is a boundary record. No shuffle of texts or
ids and no global sort; any partition may be split or merged by the second read, because starts are stored.

Defined cases: null counts as empty, which leaves one end token; a text longer than a window is cut into several
pieces; repeated rows are packed one after the other; an empty table gives no pieces. Other columns are dropped.
"""

from __future__ import annotations

import os
import sys
import zlib
from array import array
from collections.abc import Iterator
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import byte_letters
from .runtime import Memo, arrow_schema, ddl, map_columns, prepare, written

_LITTLE = sys.byteorder == "little"

LENGTH = 4096
END = 2
#: Different heads of words of a generation that a worker remembers.
HEADS = 400_000


class WordEncoder:
    """Ids of texts by a ``tokenizers`` file whose pre-tokenizer drops white space and parts letters from punctuation.

    Neither normalization nor a pre-token crosses ASCII white space, and a word's trailing punctuation is a pre-token, so
    the ids of a text are those of its words' heads and tails. Arrow splits a batch, cuts the tails off and numbers the
    different heads; ids are looked up once for each and gathered for all by index. A new head of letters alone is
    normalized here and goes to the tokenizer's model at once, any other takes all of the tokenizer's steps. Words with
    the beginning of a special token, and heads that might join their tail, stay whole. Ids are kept as 16-bit bytes.
    """

    #: ASCII punctuation but the apostrophe, which begins contractions.
    TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, file: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the executor's cores are taken by other tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        if self.tokenizer.get_vocab_size(True) > 65536:
            raise ValueError("ids must fit 16 bits")
        self._model = self.tokenizer.model
        self._bytes = str.maketrans({chr(b): c for b, c in enumerate(byte_letters()) if b != 10})
        self._marks = sorted({t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()})
        #: Whether letter runs may skip the tokenizer's own steps; tried on words of several scripts.
        tried = ["Aé", "straße", "ΑΒ", "中文", "Ñandú", "x"]
        self._direct = self._letters([self._lower(w) for w in tried]) == self._encode(tried)
        self._heads = Memo(HEADS, self._fill)
        self._tails = Memo(10_000, self._encode)

    def _encode(self, items: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch(items, add_special_tokens=False)
        return [np.array(e.ids, "<u2").tobytes() for e in got]

    def _lower(self, text: str) -> str:
        """Composed, and lower-cased letter by letter: Python's one rule that looks around is that of the final sigma."""
        if text.isascii():
            return text.lower()
        text = normalize("NFC", text)
        return "".join([c.lower() for c in text]) if "Σ" in text else text.lower()

    def _letters(self, runs: list[str]) -> list[bytes]:
        """Ids of runs of lower-case letters, as bytes through the model."""
        out, tokenize = [], self._model.tokenize
        for run in "\n".join(runs).encode().decode("latin-1").translate(self._bytes).split("\n"):
            ids = array("H", [t.id for t in tokenize(run)])
            if not _LITTLE:
                ids.byteswap()
            out.append(ids.tobytes())
        return out

    def _fill(self, heads: list[str]) -> list[bytes]:
        lower = self._lower("\n".join(heads)).split("\n")
        plain = [self._direct and h.isalpha() and low.isalpha() for h, low in zip(heads, lower, strict=True)]
        runs = iter(self._letters([low for low, p in zip(lower, plain, strict=True) if p]))
        rest = iter(self._encode([h for h, p in zip(heads, plain, strict=True) if not p]))
        return [next(runs) if p else next(rest) for p in plain]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's begin (and the last one's end)."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = lists.flatten()
        heads = pc.ascii_rtrim(words, self.TAIL)
        cut = (pc.binary_length(words).to_numpy() - pc.binary_length(heads).to_numpy()).astype(np.int64)
        whole = ~_ends_in_letter(heads) & (cut > 0) & (pc.binary_length(heads).to_numpy() > 0)
        heads = pc.ascii_lower(heads)
        for mark in self._marks:
            whole |= pc.match_substring(words, mark).to_numpy(zero_copy_only=False)
        if whole.any():
            heads = pc.if_else(pa.array(whole), words, heads)
            cut[whole] = 0
        # Words and tails take turns; a tail's code follows those of the heads, and the last code has no ids.
        coded = heads.dictionary_encode()
        names = _strings(coded.dictionary)
        known = self._heads.fetch(set(names))
        parts = [known[h] for h in names]
        code = np.empty((len(words), 2), np.int64)
        code[:, 0] = coded.indices.to_numpy()
        tails: list[str] = []
        for size in np.unique(cut[cut > 0]).tolist():
            at = np.flatnonzero(cut == size)
            some = pc.binary_slice(words.take(pa.array(at)).cast(pa.binary()), -size).cast(pa.string()).dictionary_encode()
            code[at, 1] = some.indices.to_numpy() + (len(names) + len(tails))
            tails += _strings(some.dictionary)
        code[cut == 0, 1] = len(names) + len(tails)
        known = self._tails.fetch(set(tails))
        parts += [known[t] for t in tails] + [b""]
        flat = np.frombuffer(b"".join(parts), "<u2")
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 2
        first = np.cumsum(size) - size
        code = code.reshape(-1)
        n = size[code]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
        ids = flat[np.repeat(first[code] - ends[:-1], n) + np.arange(ends[-1])]
        return ids, ends[2 * (lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py())]

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        ids, ends = self.encode(pa.array(texts, pa.string()))
        return np.split(ids, ends[1:-1]) if texts else []


def _ends_in_letter(words: pa.Array) -> np.ndarray:
    """Whether a word's last character is an ASCII letter or digit, or a letter of U+00C0 to U+00FF."""
    at = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.concatenate([np.zeros(2, np.uint8), np.frombuffer(words.buffers()[2] or b"", np.uint8)])
    last, before = data[at[1:] + 1], data[at[1:]]
    plain = np.zeros(256, bool)
    plain[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
    return (plain[last] | ((before == 0xC3) & (last != 0x97) & (last != 0xB7))) & (at[1:] > at[:-1])


def _strings(words: pa.Array) -> list[str]:
    """Strings without line feeds as a list, faster than one by one."""
    if not len(words):
        return []
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")[0].as_py().split("\n")


_encoders: dict[str, WordEncoder] = {}


def encoder(file: str) -> WordEncoder:
    if file not in _encoders:
        _encoders[file] = WordEncoder(file)
    return _encoders[file]


def encode(df: DataFrame, tokenizer_file: str, text_col: str = "text", id_col: str = "doc_id", end: int = END) -> DataFrame:
    """Pass one: ``part``, ``local_start``, ``doc_id``, ``n`` and ``ids`` (16-bit, with ``end``), written."""
    fields = [("part", "int"), ("local_start", "bigint"), ("doc_id", "bigint"), ("n", "bigint"), ("ids", "binary")]
    schema = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, part, seen = encoder(tokenizer_file), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, at = e.encode(batch.column(1))
            rows = len(at) - 1
            ids = np.insert(ids, at[1:], end)
            at = at + np.arange(rows + 1)  # an end token for each document before
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(rows, part, np.int32)), pa.array(seen + at[:-1]), batch.column(0), pa.array(np.diff(at)),
                pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer((2 * at).astype(np.int32)), pa.py_buffer(ids.astype("<u2"))]),
            ], schema=schema)
            seen += int(at[-1])

    prepare(df.sparkSession)
    docs = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return written(docs.mapInArrow(run, ddl(fields)))


def bases(encoded: DataFrame) -> dict[int, int]:
    """Tokens before each partition. One row a partition comes to the driver, never one a document."""
    totals = encoded.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    out, at = {}, 0
    for part, n in totals:
        out[part], at = at, at + n
    return out


def pack(df: DataFrame, tokenizer_file: str, length: int = LENGTH, text_col: str = "text", id_col: str = "doc_id",
         end: int = END, with_ids: bool = False) -> DataFrame:
    """A row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``
    (and ``ids`` as 32-bit little-endian bytes). Sequences are full but for the last of the corpus."""
    encoded = encode(df, tokenizer_file, text_col, id_col, end)
    base = bases(encoded)
    fields = [(c, "bigint") for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    fields += [("ids", "binary")] * with_ids

    def make():
        def step(cols):
            out: dict[str, list] = {n: [] for n, _ in fields}
            for part, local, doc, n, ids in zip(*(cols[c] for c in ("part", "local_start", "doc_id", "n", "ids")), strict=True):
                at, start = base[part] + local, 0
                wide = np.frombuffer(ids, "<u2").astype("<u4")
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    size = min(n - start, length - offset)
                    piece = wide[start : start + size].tobytes()
                    row = (doc, start, size, zlib.crc32(piece), n, sequence, offset, piece)
                    for (name, _), v in zip(fields, row, strict=False):
                        out[name].append(v)
                    start += size
            return out

        return step

    return map_columns(encoded, make, fields)
