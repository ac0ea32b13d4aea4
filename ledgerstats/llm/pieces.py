"""Encoding to subword pieces with a table of the last token of every prefix, and decoding.

The encoding of a text by pair merges in order of score is the only split into tokens in
which every two neighbours are compatible: merging the two pieces' text alone gives just
these two again. So of all tokens that end at a place exactly one is the last token of the
encoding of the text up to there: the one that is compatible with the last token of what
lies before it. An automaton over the vocabulary lists the tokens that end at each place;
the table keeps the one that fits; the ids are read off the table from its end.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstats.llm.common import by_batch

SPACE = "▁"
BYTE = re.compile(r"<0x([0-9A-F]{2})>")
# Words whose ids are remembered by a task; further words are encoded each time.
REMEMBERED = 600_000


class PrefixTable:
    """Ids and text of a byte-fallback BPE model of the sentencepiece library."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if model.normalize("ﬁ Å  x ") != SPACE + "ﬁ Å  x ".replace(" ", SPACE):
            raise ValueError("only models that keep their text as it is are supported")
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.byte_id: dict[int, int] = {}
        self.surface: dict[str, str] = {}
        self.spaced: set[int] = set()
        self.automaton = ahocorasick.Automaton()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte = int(BYTE.fullmatch(piece)[1], 16)
                self.byte_id[byte] = i
                # Bytes past ASCII wait as lone surrogates until their neighbours are known.
                self.surface[str(i)] = chr(byte) if byte < 128 else chr(0xDC00 + byte)
            elif model.is_control(i):
                self.surface[str(i)] = ""
            elif model.is_unknown(i):
                self.surface[str(i)] = " ⁇ "
            else:
                self.ids[piece] = i
                if piece.startswith(SPACE):
                    self.spaced.add(i)
                self.rank[piece] = -model.get_score(i)
                self.surface[str(i)] = piece.replace(SPACE, " ")
                self.automaton.add_word(piece, (piece, len(piece)))
                if SPACE in piece.lstrip(SPACE):
                    raise ValueError("only models whose pieces lie within words are supported")
        if len(self.byte_id) != 256:
            raise ValueError("only models with byte fallback are supported")
        self.bytes = {i: byte for byte, i in self.byte_id.items()}
        self.automaton.make_automaton()
        self._compatible: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """A short text's pieces by the definition: the best pair merges, leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.rank.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        known = self._compatible.get((left, right))
        if known is None:
            known = self.merged(left + right) == [left, right]
            if len(self._compatible) < REMEMBERED:
                self._compatible[left, right] = known
        return known

    def encode_segment(self, text: str) -> list[int]:
        """The ids of a run of spaces (as `SPACE`) and the word after it."""
        last: list[str | None] = [None] * (len(text) + 1)
        pairs = self._compatible
        for end, (piece, length) in self.automaton.iter(text):
            if last[end + 1] is None:
                before = last[end + 1 - length]
                # No token ends in a character that the vocabulary lacks, and none spans it.
                if before is None:
                    last[end + 1] = piece
                else:
                    fits = pairs.get((before, piece))
                    if fits or (fits is None and self.compatible(before, piece)):
                        last[end + 1] = piece
        ids, end = [], len(text)
        while end:
            piece = last[end]
            if piece is None:
                ids += [self.byte_id[b] for b in reversed(text[end - 1].encode())]
                end -= 1
            else:
                ids.append(self.ids[piece])
                end -= len(piece)
        return ids[::-1]

    def decode(self, ids: list[str]) -> bytes:
        """The text of decimal ids in UTF-8; bytes that form no character become U+FFFD."""
        first = next((i for i, x in enumerate(ids) if self.surface[x]), len(ids))
        parts = list(map(self.surface.__getitem__, ids[first:]))
        if parts and parts[0][0] == " " and int(ids[first]) in self.spaced:
            parts[0] = parts[0][1:]
        try:
            return "".join(parts).encode()
        except UnicodeEncodeError:
            return self._decode_bytes(ids[first:], parts)

    def _decode_bytes(self, ids: list[str], parts: list[str]) -> bytes:
        """Each run of byte pieces is decoded by itself, with U+FFFD for each stray byte."""
        out, run = [], b""
        for i, part in zip([*ids, None], [*parts, ""]):
            if i is not None and int(i) in self.bytes:
                run += bytes([self.bytes[int(i)]])
                continue
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[:n].decode())
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    n = 1
                    out.append("\ufffd")
                run = run[n:]
            out.append(part)
        return "".join(out).encode()


class Words(dict):
    """Decimal ids, joined by commas, by word without its leading space."""

    def __init__(self, table: PrefixTable):
        self.table = table

    def __missing__(self, word: str) -> str:
        ids = ",".join(map(str, self.table.encode_segment(SPACE + word)))
        if len(self) < REMEMBERED and len(word) < 100:
            self[word] = ids
        return ids


class Encoder:
    def __init__(self, model_file: str):
        self.table = PrefixTable(model_file)
        self.words = Words(self.table)

    def encode(self, text: str) -> str:
        """Decimal ids joined by commas; a text is encoded as with a space before it."""
        if not text:
            return ""
        if SPACE in text:
            text = text.replace(SPACE, " ")
        words = text.split(" ")
        if "" in words:  # several spaces in a row belong to the word behind them
            text = SPACE + text.replace(" ", SPACE)
            words = [x[1:] for x in re.findall(f"{SPACE}+[^{SPACE}]*", text)]
        return ",".join(map(self.words.__getitem__, words))


_ENCODERS: dict[str, Encoder] = {}


def encoder(model_file: str) -> Encoder:
    """One encoder a worker process and model."""
    if model_file not in _ENCODERS:
        _ENCODERS[model_file] = Encoder(model_file)
    return _ENCODERS[model_file]


PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("decoded", T.StringType()),
    ]
)
DIGESTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def encode_pieces(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """Ids of every whole text, and the text decoded from them.

    Null and empty texts give no ids and empty text. Rows are independent of one another,
    so repeated rows repeat; a null doc_id is carried through; further columns are ignored.
    """

    def make():
        own = encoder(model_file)

        def columns(batch):
            joined = [own.encode(x or "") for x in batch.column(1).to_pylist()]
            ids = [x.split(",") if x else [] for x in joined]
            return {
                "doc_id": batch.column(0),
                "ids": [list(map(int, x)) for x in ids],
                "decoded": [own.table.decode(x).decode() for x in ids],
            }

        return columns

    return by_batch(docs.select(F.col("doc_id").cast("long"), text), make, PIECES)


def piece_digests(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """Number of ids and digests of ids and decoded text, of the same encoding."""

    def make():
        own = encoder(model_file)

        def one(text: str | None) -> tuple[int, str, str]:
            joined = own.encode(text or "")
            ids = joined.split(",") if joined else []
            decoded = own.table.decode(ids)
            return (
                len(ids),
                hashlib.sha256(joined.encode()).hexdigest(),
                hashlib.sha256(decoded).hexdigest(),
            )

        def columns(batch):
            rows = [one(x.as_py()) for x in batch.column(1)]
            n, ids, decoded = zip(*rows) if rows else ((), (), ())
            return {
                "doc_id": batch.column(0),
                "n_tokens": n,
                "ids_sha256": ids,
                "decoded_sha256": decoded,
            }

        return columns

    return by_batch(docs.select(F.col("doc_id").cast("long"), text), make, DIGESTS)
