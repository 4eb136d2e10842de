"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

The encoding of any prefix of a word ends in exactly one token. A suffix-link automaton over the vocabulary lists the
tokens that end at each place of the word; the last token of a prefix is the one that may follow the last token of what
lies before it. Two tokens may stand side by side if no merge that would have been made earlier joins symbols across
their border; that is found by undoing merges on either side. One pass stores the last token of every prefix, and the
back pointers give the ids, the same as those of merging pairs by rank.

Words come from the tokenizer's own splitting. Texts are split at spaces first, as no normalisation or piece reaches
across one, and the pieces of each chunk are remembered.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.rows import releasing, slices

#: Entries that each worker's table of remembered pieces holds at most; that of odd chunks holds an eighth of them.
REMEMBERED = 400_000

#: Characters of the longest key that is remembered.
LONGEST_REMEMBERED = 64

#: Pairs of tokens that each worker remembers at most.
REMEMBERED_PAIRS = 150_000

ENCODED = "doc_id long, ids binary"
DECODED = f"{ENCODED}, text string"

#: Chunks of ASCII and precomposed Latin letters; normalising them means to lower their case.
_PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-įĲ-ňŊ-ž]+")
_PLAIN_TEXT = re.compile("[ \n\x21-\x7eÀ-ÖØ-öø-įĲ-ňŊ-ž]*")

#: The tokenizer's own pieces, in the form they take for plain text in lower case, whose letters are these.
_LETTERS = "a-zß-öø-ž"
_PIECES = re.compile(rf"[{_LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\s0-9{_LETTERS}]+")

_EXPECTED = ("NFC", r"\s+", "Lowercase", r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def byte_characters() -> list[str]:
    """The character that byte-level vocabularies write for each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    table = {byte: chr(byte) for byte in printable} | {byte: chr(256 + n) for n, byte in enumerate(others)}
    return [table[byte] for byte in range(256)]


class Remembering(dict):
    """A table that makes what it lacks; when half full it forgets what wasn't asked for since it was last half full.

    Long keys, such as texts without spaces, aren't kept, so the bytes of a table are bounded as its entries are.
    """

    def __init__(self, make: Callable, most: int = REMEMBERED) -> None:
        super().__init__()
        self.make, self.half, self._older = make, most // 2, {}

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self.make(key)
            if isinstance(key, str) and len(key) > LONGEST_REMEMBERED:
                return value
        if len(self) >= self.half:
            self._older = dict(self)
            self.clear()
        self[key] = value
        return value


class Splitter:
    """Chunks of text to the pieces that are encoded one by one, in the vocabulary's characters."""

    def __init__(self, content: str) -> None:
        from tokenizers import Tokenizer

        described = json.loads(content)
        normalizers = described["normalizer"]["normalizers"]
        split = described["pre_tokenizer"]["pretokenizers"][0]
        found = (normalizers[0]["type"], normalizers[1]["pattern"]["Regex"], normalizers[2]["type"])
        if (*found, split["pattern"]["Regex"]) != _EXPECTED:
            raise ValueError("this vocabulary splits text in another way")
        self.tokenizer = Tokenizer.from_str(content)
        self.special = {token["content"]: token["id"] for token in described["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.characters = byte_characters()

    def pieces(self, chunk: str) -> Iterator[str | int]:
        """Pieces in order; the id where a special token's text stands."""
        if _PLAIN.fullmatch(chunk) and "<|" not in chunk:
            for piece in _PIECES.findall(chunk.lower()):
                yield piece if piece.isascii() else "".join(map(self.characters.__getitem__, piece.encode()))
            return
        for part in self._special.split(chunk):
            if part in self.special:
                yield self.special[part]
            elif part:
                # Pairs of surrogates can't occur in a text column; all else goes through the tokenizer's own rules.
                normal = self.tokenizer.normalizer.normalize_str(part)
                for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
                    yield piece


class PrefixEncoder:
    """Last token of every prefix, over the merges of a vocabulary file."""

    def __init__(self, content: str) -> None:
        import ahocorasick

        model = json.loads(content)["model"]
        vocabulary: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        merges = [tuple(pair) for pair in model["merges"]]
        symbols = [c + e for e in ("", self.end) for c in byte_characters()]
        #: Tokens are numbered by rank here: symbols first, then one per merge in order.
        number = {symbol: n for n, symbol in enumerate(symbols)}
        self.left, self.right = list(range(len(symbols))), list(range(len(symbols)))
        self.joined: dict[tuple[int, int], int] = {}
        text = [chr(n) for n in range(len(symbols))]
        for left, right in merges:
            made = left + right
            if made in number:
                raise ValueError(f"two merges make {made!r}")
            pair = (number[left], number[right])
            number[made] = self.joined[pair] = len(text)
            text.append(text[pair[0]] + text[pair[1]])
            self.left.append(pair[0])
            self.right.append(pair[1])
        self.identifier = [0] * len(text)
        for token, n in number.items():
            self.identifier[n] = vocabulary[token]
        self.symbol = {c: (chr(number[c]), chr(number[c + self.end])) for c in byte_characters()}
        sound = [True] * len(text)
        self.automaton = ahocorasick.Automaton()
        for n in range(len(text)):
            if n >= len(symbols):
                # A token that merging by rank would never leave whole takes no part.
                left, right = self.left[n], self.right[n]
                sound[n] = sound[left] and sound[right] and self._apart(left, right, n)
            if sound[n]:
                self.automaton.add_word(text[n], (len(text[n]), n))
        self.automaton.make_automaton()
        self.whole = {text[n]: n for n in range(len(text)) if sound[n]}
        #: A pair of tokens is one number.
        self.compatible = Remembering(lambda pair: self._apart(*divmod(pair, len(text)), len(text)), REMEMBERED_PAIRS)
        self.count = len(text)

    def _apart(self, left: int, right: int, limit: int) -> bool:
        """Whether no merge of a rank below ``limit`` would have joined symbols across the border of two tokens."""
        while True:
            joined = self.joined.get((left, right))
            if joined is not None and joined < limit:
                return False
            # Undo the later of the two merges; a symbol has none to undo, then it is the other's turn.
            for side in ("left", "right") if left > right else ("right", "left"):
                if side == "left" and self.right[left] != left:
                    limit, left = left, self.right[left]
                    break
                if side == "right" and self.left[right] != right:
                    limit, right = right + 1, self.left[right]
                    break
            else:
                return True

    def ids(self, piece: str) -> list[int]:
        plain, last_symbol = piece[:-1], piece[-1]
        symbols = "".join([self.symbol[c][0] for c in plain]) + self.symbol[last_symbol][1]
        if (known := self.whole.get(symbols)) is not None:
            return [self.identifier[known]]
        last: list[int] = [-1] * (len(symbols) + 1)
        length_of: list[int] = [0] * (len(symbols) + 1)
        compatible, count = self.compatible, self.count
        for end, (length, token) in self.automaton.iter(symbols):
            if last[end + 1] < 0:
                start = end + 1 - length
                if start == 0 or compatible[last[start] * count + token]:
                    last[end + 1], length_of[end + 1] = token, length
        found, place = [], len(symbols)
        while place:
            found.append(self.identifier[last[place]])
            place -= length_of[place]
        return found[::-1]


class TextEncoder:
    """Whole texts to packed ids (little-endian, 32 bits), by any way of encoding one piece."""

    def __init__(self, splitter: Splitter, ids_of_piece: Callable[[str], list[int]], most: int = REMEMBERED) -> None:
        characters = splitter.characters

        def encode_piece(piece: str) -> bytes:
            return array("I", ids_of_piece(piece)).tobytes()

        def encode_plain(piece: str) -> bytes:
            return encode_piece(piece if piece.isascii() else "".join(map(characters.__getitem__, piece.encode())))

        def encode_chunk(chunk: str) -> bytes:
            parts = splitter.pieces(chunk)
            return b"".join(encode_piece(part) if isinstance(part, str) else array("I", [part]).tobytes() for part in parts)

        #: Pieces of plain text, as they stand there in lower case, and chunks of other text.
        self._pieces, self._chunks = Remembering(encode_plain, most), Remembering(encode_chunk, most // 8)

    def packed(self, text: str | None) -> bytes:
        """The ids of a text. Plain text is cut into pieces at one go, other text line by line and chunk by chunk."""
        if not text:
            return b""
        if self._is_plain(text):
            return self._plain(text)
        parts = (
            self._plain(line) if self._is_plain(line) else b"".join(map(self._chunks.__getitem__, line.split(" ")))
            for line in text.split("\n")
        )
        return b"".join(parts)

    @staticmethod
    def _is_plain(text: str) -> bool:
        return _PLAIN_TEXT.fullmatch(text) is not None and "<|" not in text

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, _PIECES.findall(text.lower())))


_BUILT: dict[tuple[str, int], object] = {}


def built(make: Callable, content: str):
    """One object per worker process and vocabulary."""
    key = (f"{make.__module__}.{make.__qualname__}", hash(content))
    if key not in _BUILT:
        _BUILT[key] = make(content)
    return _BUILT[key]


def prefix_text_encoder(content: str) -> TextEncoder:
    return TextEncoder(Splitter(content), PrefixEncoder(content).ids)


def token_texts(content: str) -> list[str]:
    """Token text by id, special tokens included."""
    described = json.loads(content)
    texts = {n: token for token, n in described["model"]["vocab"].items()}
    texts |= {token["id"]: token["content"] for token in described["added_tokens"]}
    return [texts[n] for n in range(len(texts))]


def read_vocabulary(path: str) -> str:
    """The vocabulary file, read by the driver; workers get its content, as they may lack the file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _encoded(batches: Iterator[pa.RecordBatch], content: str) -> Iterator[pa.RecordBatch]:
    encoder = built(prefix_text_encoder, content)
    for batch in slices(batches):
        packed = [encoder.packed(text) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(packed, pa.binary())], ["doc_id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], content: str) -> Iterator[pa.RecordBatch]:
    texts = built(token_texts, content)
    for batch in slices(batches):
        decoded = [
            " ".join([texts[n] for n in np.frombuffer(packed or b"", "<u4").tolist()])
            for packed in batch.column("ids").to_pylist()
        ]
        columns = [batch.column("doc_id"), batch.column("ids"), pa.array(decoded, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "text"])


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and ids (packed: little-endian unsigned 32-bit integers) of every row of ``docs`` (doc_id, text).

    A NULL text counts as empty and has no ids. Ids may be NULL and rows may repeat: one row comes out for each that
    goes in. Other columns are ignored. ``vocabulary`` is the path of the vocabulary file on the driver.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        releasing(lambda batches: _encoded(batches, shared.value)), ENCODED
    )


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids and text of ``encoded`` (doc_id, packed ids): token texts joined by spaces, special ones kept.

    The vocabulary names no decoder, so the marks of word ends stay. No ids, or NULL, give an empty text.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    return encoded.select("doc_id", "ids").mapInArrow(
        releasing(lambda batches: _decoded(batches, shared.value)), DECODED
    )


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``decode(encode(docs))`` within the same tasks: doc_id, ids, text."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        releasing(lambda batches: _decoded(_encoded(batches, shared.value), shared.value)), DECODED
    )


def n_tokens(packed: Column) -> Column:
    return (F.octet_length(packed) / 4).cast("long")


def round_trip_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document, encoded and decoded again."""
    return round_trip(docs, vocabulary).select(
        "doc_id",
        n_tokens(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
