import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_rows import documents, odd_rows, with_clashing_columns

from tillmark.llm import bpe, token_files
from tillmark.llm.queries import END_ID, vocabulary_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def texts():
    rng = random.Random(2)
    odd = "abAB '’.,!<|>endoftextstart \n\t\r\x1c\x85\xa0 éÉe\u0301\u0301İıſßΣς ǅ中文字1٣½\u200b😀ﬁA\u030a'sll're_-"
    made = ["".join(rng.choice(odd) for _ in range(rng.randrange(60))) for _ in range(1500)]
    made += ["".join(rng.choice("ab") for _ in range(rng.randrange(80))) for _ in range(200)]
    syllables = ["an", "in", "th", "er", "s", "e", "ing", "the", "'s", "."]
    made += ["".join(rng.choice(syllables) for _ in range(rng.randrange(30))) for _ in range(800)]
    return made + ["a" * n for n in range(100)] + ["<|endoftext|>", "x<|endoftext|>y", "<|startoftext|>'s", "the" * 3000]


def test_ids_are_those_of_the_library(tokenizer):
    content = bpe.read_vocabulary(vocabulary_path())
    encoders = [bpe.prefix_text_encoder(content), token_files.library_text_encoder(content)]
    for text in texts():
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        for encoder in encoders:
            assert np.frombuffer(encoder.packed(text), "<u4").tolist() == expected, text


def test_a_full_table_forgets_and_stays_right():
    table = bpe.Remembering(lambda key: key * 2, most=10)
    assert [table[n % 17] for n in range(500)] == [n % 17 * 2 for n in range(500)]
    assert len(table) <= 5


def test_round_trip_of_odd_rows(spark, tokenizer):
    frame = with_clashing_columns(documents(spark, odd_rows()))
    found = bpe.round_trip_digests(frame, vocabulary_path()).collect()
    expected = []
    for doc_id, text in odd_rows():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected.append((doc_id, len(ids), digest, hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_encode_then_decode_is_the_round_trip(spark):
    frame = documents(spark, odd_rows(200))
    path = vocabulary_path()
    apart = bpe.decode(bpe.encode(frame, path), path).collect()
    assert sorted(map(repr, apart)) == sorted(map(repr, bpe.round_trip(frame, path).collect()))
    assert bpe.round_trip(documents(spark, []), path).count() == 0


def test_token_files(spark, tmp_path, tokenizer):
    rows = odd_rows(500) + [(n, f"text number {n}") for n in range(100, 1100)]
    folder = f"{tmp_path}/tokens"
    frame = with_clashing_columns(documents(spark, rows)).repartition(5)
    files = token_files.write_tokens(frame, vocabulary_path(), folder, END_ID)
    # The vocabulary fits into 16 bits.
    assert {row["width"] for row in files.collect()} == {2}
    found = sorted(token_files.read_tokens(spark, folder, with_ids=True).collect(), key=lambda row: row["start"])
    at = 0
    for row in found:
        assert row["start"] == at
        at += row["n_tokens"]
        assert row["n_tokens"] == len(row["ids"]) // 4 and row["ids_crc32"] == zlib.crc32(row["ids"])
    assert [row["doc_id"] for row in found] == sorted((d for d, _ in rows), key=lambda d: -1 if d is None else d)
    encoded = sorted(
        (-1 if d is None else d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, END_ID]) for d, t in rows
    )
    read = sorted((-1 if r["doc_id"] is None else r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in found)
    assert read == encoded


def test_token_files_of_an_empty_table(spark, tmp_path):
    folder = f"{tmp_path}/tokens"
    token_files.write_tokens(documents(spark, []), vocabulary_path(), folder, END_ID)
    assert token_files.read_tokens(spark, folder).count() == 0


def test_long_keys_are_not_remembered():
    made = []
    table = bpe.Remembering(lambda key: made.append(key) or len(key), 10)
    long = "x" * 1000
    assert [table[key] for key in ("ab", long, "ab", long)] == [2, 1000, 2, 1000]
    assert made == ["ab", long, long] and list(table) == ["ab"]


def test_plain_pieces_are_the_tokenizers_own():
    """Every character of plain texts, on both sides of every kind of character."""
    splitter = bpe.Splitter(open(vocabulary_path(), encoding="utf-8").read())
    plain = [chr(c) for c in range(0x21, 0x180) if bpe._PLAIN.fullmatch(chr(c))]
    for left in plain:
        text = "".join(f"{left}{right}{left} " for right in ["a", "Z", "é", "1", "_", "'", "s", "'re", "\n", "!", *plain[::7]])
        normal = splitter.tokenizer.normalizer.normalize_str(text)
        own = [piece for piece, _ in splitter.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        found = bpe._PIECES.findall(text.lower())
        assert ["".join(map(splitter.characters.__getitem__, piece.encode())) for piece in found] == own
