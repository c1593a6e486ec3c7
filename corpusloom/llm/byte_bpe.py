"""Byte-level BPE through a sentencepiece model that is serialised from a rank file, never trained.

Each token's bytes become printable characters one to one; a token is a piece with score ``-rank`` under identity
normalization, so the library's best-score merges are the rank file's lowest-rank merges. Texts are cut into
pre-tokens first and each is encoded by itself; ids are the ranks. A pre-token that is a token as a whole is that token,
whatever merges lead to, as in the rank file's library. Decoding maps ids to the model's pieces, and their characters
back to bytes.

Defined cases: null counts as empty and has no ids; every byte must be a token of the rank file; special tokens don't
exist, their strings are ordinary text; repeated rows are encoded alike; a very long text is one row, held at once; an
empty table gives no rows; other columns are dropped (``decoded`` keeps them), whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import Memo, prepare, with_columns

#: Pre-tokens of a generation whose ids a worker remembers.
CACHE = 250_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def byte_letters() -> list[str]:
    """A printable character for each byte: itself where it is one, else one from U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model of a rank file. Piece ids are ranks; the unknown piece comes last."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    order = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in order] != list(range(len(order))):
        raise ValueError("ranks must be 0, 1, 2 and so on")
    letters = byte_letters()
    model = pb.ModelProto()
    for rank, token in enumerate(order):
        model.pieces.add(piece="".join(letters[b] for b in token), score=float(-rank), type=pb.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    t = model.trainer_spec
    t.model_type, t.vocab_size, t.byte_fallback = pb.TrainerSpec.BPE, len(model.pieces), False
    t.unk_id, t.bos_id, t.eos_id, t.pad_id = len(order), -1, -1, -1
    n = model.normalizer_spec
    n.name, n.precompiled_charsmap = "identity", b""
    n.add_dummy_prefix = n.remove_extra_whitespaces = n.escape_whitespaces = False
    return model.SerializeToString()


class ByteBpe:
    def __init__(self, rank_file: str, pattern: str) -> None:
        import sentencepiece

        ranks = read_ranks(rank_file)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=serialise(ranks))
        self.ranks = ranks
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.bytes_of = [bytes(map(byte_of.__getitem__, self.processor.id_to_piece(i))) for i in range(len(ranks))]
        #: In the rank file's pattern white space is Unicode's White_Space; four control characters aren't.
        self.split = regex.compile(pattern.replace("\\s", "\\p{White_Space}").replace("\\S", "\\P{White_Space}")).findall
        self._table = str.maketrans({chr(b): c for b, c in enumerate(byte_letters())})
        self._known = Memo(CACHE, self._fill)

    def _fill(self, missing: list[str]) -> list[tuple[int, ...]]:
        whole = [self.ranks.get(p.encode()) for p in missing]
        rest = [p.encode().decode("latin-1").translate(self._table) for p, rank in zip(missing, whole, strict=True) if rank is None]
        merged = iter(self.processor.encode(rest, num_threads=1))
        return [tuple(next(merged)) if rank is None else (rank,) for rank in whole]

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        pieces = [self.split(t) if t else [] for t in texts]
        known = self._known.fetch(set().union(*pieces)).__getitem__
        return [list(chain.from_iterable(map(known, ps))) for ps in pieces]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_codecs: dict[tuple[str, str], ByteBpe] = {}


def codec(rank_file: str, pattern: str) -> ByteBpe:
    if (rank_file, pattern) not in _codecs:
        _codecs[rank_file, pattern] = ByteBpe(rank_file, pattern)
    return _codecs[rank_file, pattern]


def with_ids(df: DataFrame, rank_file: str, pattern: str, text_col: str = "text", id_col: str = "doc_id",
             out: str = "ids") -> DataFrame:
    """``id_col`` and the text's ids (``array<int>``)."""

    def make():
        c = codec(rank_file, pattern)
        return lambda cols: {out: c.encode_batch(cols["text"])}

    prepare(df.sparkSession)
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return with_columns(docs, ["text"], make, [(out, "array<int>")]).drop("text")


def decoded(df: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids", out: str = "bytes") -> DataFrame:
    """``df`` with the bytes that ``ids_col`` stands for."""

    def make():
        c = codec(rank_file, pattern)
        return lambda cols: {out: [c.decode(x or []) for x in cols[ids_col]]}

    return with_columns(df, [ids_col], make, [(out, "binary")])


def digests(df: DataFrame, rank_file: str, pattern: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_tokens`` and SHA-256 of the decimal ids and of the decoded bytes, encoded and decoded in one pass."""

    def make():
        c = codec(rank_file, pattern)
        names = list(map(str, range(len(c.ranks))))

        def step(cols):
            ids = c.encode_batch(cols["text"])
            return {
                "n_tokens": list(map(len, ids)),
                "ids_sha256": [hashlib.sha256(" ".join([names[i] for i in x]).encode()).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(c.decode(x)).hexdigest() for x in ids],
            }

        return step

    prepare(df.sparkSession)
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    fields = [("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    return with_columns(docs, ["text"], make, fields).drop("text")
