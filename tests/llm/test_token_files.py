"""The range coder and files of token ids: exact round trips and the named tokenizer."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crowdgrid.llm import block_coder, range_coder, token_files, token_ids
from crowdgrid.llm.common import table
from crowdgrid.llm.queries import QUERIES

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(token_files.default_tokenizer())


def plain(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def round_trip(blocks, bits, most=4096):
    blocks = [np.asarray(b, dtype=np.uint32) for b in blocks]
    codes = range_coder.encode(blocks, bits, most)
    back = range_coder.decode(codes, [len(b) for b in blocks], bits, most)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back)) and len(back) == len(blocks)
    return codes


@pytest.mark.parametrize("bits", [1, 2, 9, 16, 17, 23])
def test_random_blocks_come_back(bits):
    r = np.random.default_rng(bits)
    most = 1 << bits
    blocks = [r.integers(0, most, n) for n in (0, 1, 2, 3, 700, 0, 50, 701, 2048)]
    blocks += [np.minimum(r.zipf(1.2, 900) - 1, most - 1), np.full(3000, most - 1), np.zeros(5)]
    blocks += [np.arange(4000) % most, np.tile(r.integers(0, most, 7), 200)]
    round_trip(blocks, bits)


def test_nothing_to_code():
    assert range_coder.encode([], 16, 9) == [] and range_coder.decode([], [], 16, 9) == []
    round_trip([[]], 16)


def test_blocks_do_not_depend_on_their_neighbours():
    r = np.random.default_rng(5)
    blocks = [r.zipf(1.3, n) % 5000 for n in (300, 10, 2000, 1)]
    together = round_trip(blocks, 16)
    assert together == [round_trip([b], 16)[0] for b in blocks]


def test_what_the_models_learn_saves_bytes():
    r = np.random.default_rng(6)
    ids = np.minimum(r.zipf(1.5, 4096), 40000)
    phrase = np.tile(r.integers(0, 49000, 40), 100)
    even = r.integers(0, 1 << 16, 4096)
    size = {n: len(round_trip([b], 16)[0]) for n, b in (("zipf", ids), ("phrase", phrase), ("even", even))}
    assert size["phrase"] < 0.1 * 2 * len(phrase)
    assert size["zipf"] < 0.6 * 2 * len(ids)
    assert size["even"] < 1.05 * 2 * len(even)


def test_straddling_ranges_come_back():
    """Many short blocks with few ids, so that the narrow ranges meet all word borders."""
    r = np.random.default_rng(8)
    round_trip([r.integers(0, r.integers(1, 40), r.integers(0, 400)) for _ in range(2000)], 16)


def test_files_are_checked():
    texts = [np.arange(n, dtype="<u4").tobytes() for n in (5000, 0, 10)]
    data = token_files.pack_file([3, None, 9], texts, 16)
    assert list(token_files.unpack_file(data)) == [(3, texts[0]), (None, b""), (9, texts[2])]
    assert np.array_equal(token_files.read_blocks(data, 1, 2), np.arange(2048, 4096))
    for at in (0, 6, 40, len(data) // 2, len(data) - 3):
        broken = bytearray(data)
        broken[at] ^= 64
        with pytest.raises(ValueError):
            list(token_files.unpack_file(bytes(broken)))
    with pytest.raises(ValueError):
        token_files.pack_file([1], [np.array([70000], dtype="<u4").tobytes()], 16)


def odd_texts():
    r = random.Random(4)
    letters = "ab cdé ß ñÑ ÀÈ'STvell 12½²_ -.,!? \t\n\x0b\x0c\r\x85\xa0 \x00\x1c\xad İıſΣς ΟΣ. 漢字 é \U0001f600 ǅ ﬁ"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(1500)]
    return texts + [
        "<|endoftext|>", "a<|endoftext|>b <|startoftext|> c", "<|ENDOFTEXT|>", "it's WE'LL they'Re 's 't", "x" * 3000,
        "9" * 200, "don't", "é e ́x", "Å", "İstanbul IŞIK", "ẞ", "ab​cd", "½ ² Ⅷ",
    ]


def test_ids_are_those_of_the_library(tokenizer):
    encoder = token_ids.TokenIds(token_files.default_tokenizer())
    assert encoder.pattern is not None
    for text in odd_texts() * 2:
        got = np.frombuffer(encoder.ids(text), dtype="<u4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_other_tokenizers_read_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, plain_ = token_ids.TokenIds(path), Tokenizer.from_file(path)
    assert encoder.pattern is None and encoder.id_bits == 16
    for text in ("two  words\n", "a <|endoftext|> b"):
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == plain_.encode(text, add_special_tokens=False).ids


def test_bounded_memory_of_chunks(monkeypatch, tokenizer):
    monkeypatch.setattr(token_ids, "MOST_CHUNKS", 5)
    encoder = token_ids.TokenIds(token_files.default_tokenizer())
    text = " ".join(f"word{i} Other{i}" for i in range(50)) + " " + "long" * 40
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == plain(tokenizer, text)[:-1]
    assert len(encoder.chunks) <= 5 and len(encoder.parts) <= 5


def test_files_of_the_former_coder_are_refused():
    data = token_files.pack_file([1], [np.arange(9, dtype="<u4").tobytes()], 16)
    with pytest.raises(ValueError, match="not a file"):
        token_files.read_blocks(b"CGI1" + data[4:])


def test_words_of_letters_are_not_searched(tokenizer):
    encoder = token_ids.TokenIds(token_files.default_tokenizer())
    text = "Plain words, Été naïve <|endoftext|> x<|endoftext|>y ǅ İstanbul ﬁn e\u0301 12ab straße 語"
    wanted = np.array(plain(tokenizer, text)[:-1], dtype="<u4").tobytes()
    assert encoder.ids_of(text.encode()) == encoder.ids(text) == wanted
    words = token_ids.TokenIds(token_files.default_tokenizer())
    words.added = None  # a search would fail
    text = "plain Words été Naïve"
    assert words.ids_of(text.encode()) == np.array(plain(tokenizer, text)[:-1], dtype="<u4").tobytes()


def test_codes_are_what_they_were():
    r = np.random.default_rng(11)
    blocks = [np.minimum(r.zipf(1.3, n), 49_999).astype("<u4") for n in (2048, 700, 1, 0, 2048)]
    codes = range_coder.encode(blocks, 16, 2048)
    assert zlib.crc32(b"".join(codes)) == 0xbbf64306
    back = range_coder.decode(codes, [len(b) for b in blocks], 16, 2048)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back))


def test_frequencies_of_classes_are_set_for_many_steps_at_once(monkeypatch):
    steps = []
    whole = range_coder._Models.set_classes
    monkeypatch.setattr(range_coder._Models, "set_classes", lambda self: (steps.append(1), whole(self)))
    r = np.random.default_rng(9)
    round_trip([r.integers(0, 60000, n) for n in (2048, 2048, 31)], 16)
    assert len(steps) == 2 * 2048 // range_coder.PERIOD


def expected(tokenizer, rows):
    """By ascending doc_id; rows are unique in it."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = plain(tokenizer, text)
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        out.append((doc_id, start, len(ids), crc))
        start += len(ids)
    return out


def digests(found):
    got = found.select("doc_id", "start", F.expr("octet_length(ids) div 4"), F.crc32("ids")).collect()
    return sorted((tuple(r) for r in got), key=lambda r: (r[1], r[2]))


def test_documents_of_the_tables(spark, sf_dir, tokenizer):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op13_token_files"](spark, sf_dir).collect()), key=lambda r: r[1])
    assert got == expected(tokenizer, rows)


def test_many_small_files_and_odd_texts(spark, tokenizer):
    rows = [(i * 7919 % 100_003, t) for i, t in enumerate(odd_texts())] + [(None, "no id"), (-5, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("data", F.lit(1)).withColumn("part", F.lit("p"))
    files = token_files.write_files(docs.repartition(5), block_ids=64, file_ids=500)
    assert files.count() > 20
    assert files.agg(F.max(F.length("data"))).first()[0] < 20_000
    assert digests(token_files.document_ids(files)) == expected(tokenizer, rows)


def test_checks_agree_with_the_ids(spark):
    files = token_files.write_files(spark.createDataFrame([(i % 9, "x " * i) for i in range(40)], DOCS), file_ids=30)
    checks = token_files.document_checks(files).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted((tuple(r) for r in checks), key=lambda r: (r[1], r[2])) == digests(token_files.document_ids(files))


def test_checks_take_no_ids_out_of_the_reader(spark, monkeypatch, tokenizer):
    rows = [(3, "one two"), (None, None), (1, "three")]
    files = token_files.write_files(spark.createDataFrame(rows, DOCS))
    monkeypatch.setattr(token_files, "read_files", None)
    checks = token_files.document_checks(files).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted((tuple(r) for r in checks), key=lambda r: (r[1], r[2])) == expected(tokenizer, rows)


def test_long_texts_lie_in_one_file(spark, tokenizer):
    rows = [(1, "word " * 150_000), (2, "b" * 50_000), (3, " " * 2_000_000), (4, "\n" * 2_000_000 + "x")]
    files = token_files.write_files(spark.createDataFrame(rows, DOCS), file_ids=1000)
    assert digests(token_files.document_ids(files)) == expected(tokenizer, rows)


def test_repeated_rows_and_one_crowded_id(spark, tokenizer):
    rows = [(7, f"text {i % 3}") for i in range(400)] + [(8, "last")]
    files = token_files.write_files(spark.createDataFrame(rows, DOCS).repartition(9), file_ids=50)
    got = digests(token_files.document_ids(files))
    assert sorted(g[2:] for g in got) == sorted(e[2:] for r in rows for e in expected(tokenizer, [r]))
    assert got[-1][0] == 8
    starts = [g[1] for g in got]
    assert starts == [sum(g[2] for g in got[:i]) for i in range(len(got))]


def test_no_documents(spark):
    files = token_files.write_files(spark.createDataFrame([], DOCS))
    assert files.count() == 0 and token_files.document_ids(files).collect() == []


def test_blocks_of_shared_tables_come_back():
    r = np.random.default_rng(12)
    for bits in (1, 2, 9, 16, 23):
        most = 1 << bits
        blocks = [r.integers(0, most, n) for n in (0, 1, 2, 3, 700, 0, 50, 701, 2048)]
        blocks += [np.minimum(r.zipf(1.2, 900) - 1, most - 1), np.full(3000, most - 1), np.zeros(5, int)]
        blocks += [np.arange(4000) % most, np.tile(r.integers(0, most, 7), 200)]
        blocks += [r.integers(0, min(most, r.integers(1, 40)), r.integers(0, 400)) for _ in range(300)]
        codes, tables = block_coder.encode(blocks, bits, 4096)
        back = block_coder.decode(codes, tables, [len(b) for b in blocks], bits, 4096)
        assert len(back) == len(blocks) and all(np.array_equal(a, b) for a, b in zip(blocks, back))
    assert block_coder.encode([], 16, 9)[0] == [] and block_coder.decode([], b"", [], 16, 9) == []


def test_shared_tables_save_as_many_bytes():
    r = np.random.default_rng(13)
    blocks = [np.minimum(r.zipf(1.3, 2048) - 1, 49_407) for _ in range(600)]
    codes, tables = block_coder.encode(blocks, 16, 2048)
    former = range_coder.encode([b.astype("<u4") for b in blocks], 16, 2048)
    assert len(tables) + sum(map(len, codes)) < 1.01 * sum(map(len, former))


def test_groups_of_blocks_are_read_by_themselves(monkeypatch):
    monkeypatch.setattr(token_files, "LANES", 3)
    ids = (np.arange(1000) ** 2 % 977).astype("<u4")
    data = token_files.pack_file([1], [ids.tobytes()], 16, block_ids=64)
    monkeypatch.undo()
    assert list(token_files.unpack_file(data)) == [(1, ids.tobytes())]
    for first, last in ((0, 1), (2, 4), (3, 6), (4, 11), (15, 16)):
        assert np.array_equal(token_files.read_blocks(data, first, last), ids[64 * first : 64 * last])
    for at in range(0, len(data), 7):
        broken = bytearray(data)
        broken[at] ^= 255
        with pytest.raises(ValueError):
            token_files.read_blocks(bytes(broken))


def test_files_of_the_former_mark_are_read():
    ids = np.arange(5000, dtype="<u4")
    blocks = [ids[at : at + 2048] for at in range(0, 5000, 2048)]
    codes = range_coder.encode(blocks, 16, 2048)
    head = np.array([(16, 2048, 1, 5000, 3)], dtype=token_files._HEAD)
    docs = np.array([(1, 7, 5000)], dtype=token_files._DOC)
    table = [(len(c), zlib.crc32(c), zlib.crc32(b)) for c, b in zip(codes, blocks)]
    front = b"CGI2" + head.tobytes() + docs.tobytes() + np.array(table, dtype=token_files._BLOCK).tobytes()
    data = b"".join([front, zlib.crc32(front).to_bytes(4, "little"), *codes])
    assert list(token_files.unpack_file(data)) == [(7, ids.tobytes())]


def test_a_word_is_encoded_once_for_all_its_chunks(tokenizer):
    encoder = token_ids.TokenIds(token_files.default_tokenizer())
    whole, met = encoder.word, []
    encoder.word = lambda letters: met.append(letters) or whole(letters)
    text = "Blexqz blexqz, BLEXQZ. blexqz! blexqz <|endoftext|> word's 's"
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == plain(tokenizer, text)[:-1]
    assert met == [b"blexqz"]
