"""Token ids, counts, files and packing against the tokenizer library itself."""

import random
import weakref
import zlib
from collections import defaultdict

import numpy as np
import pytest

from recordtide.llm import packing, token_counts, token_files
from recordtide.llm import words as W
from recordtide.llm.encoding import Encoder, Parts, counted_parts, cut_at_spaces, encoder, load_tokenizer
from recordtide.llm.tables import tokenizer_file
from tests.llm.conftest import ODD_ROWS

BYTES, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"
BITS = [" "] * 5 + ["  ", "\n", "\t", " \n", "\0", "\x1c", "\x85", "　", "᠎", "a", "Bc", "'s", "'ll", "1", "23", "é", "ß", "İ", "Σ", "<|endoftext|>", "!", "...", "日本", "é", "́", "\U0001f600"]


def odd_text(seed, n):
    choose = random.Random(seed)
    return "".join(choose.choice(BITS) for _ in range(choose.randint(0, n)))


@pytest.fixture(scope="module")
def tokenizers():
    return {name: load_tokenizer(tokenizer_file(name)) for name in (BYTES, WORDS)}


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_parts_encode_like_the_whole(tokenizers, monkeypatch):
    monkeypatch.setattr("recordtide.llm.encoding.REMEMBERED", 50)
    texts = [odd_text(k, 16) for k in range(4000)]
    assert all("".join(cut_at_spaces(t)) == t for t in texts)
    got = Encoder(tokenizer_file(BYTES)).ids(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [ids_of(tokenizers[BYTES], t) for t in texts]
    counts = [sum(v) for v in Parts(tokenizer_file(WORDS), len).look_up([cut_at_spaces(t) for t in texts])]
    assert counts == [len(ids_of(tokenizers[WORDS], t)) for t in texts]


def test_overlapping_chunks_count_like_the_whole(tokenizers):
    for k in range(1500):
        text, choose = odd_text(k, 150), random.Random(k)
        if k % 3 == 0:
            text = text.replace(" ", "")  # few boundaries: overlaps widen, up to the whole text
        n = token_counts.count_huge(tokenizers[WORDS], text, choose.choice([5, 17, 40]), choose.choice([1, 3, 8]))
        assert n == len(ids_of(tokenizers[WORDS], text)), text


def test_token_counts(tokenizers, odd, none):
    expected = sorted(((a, len((b or "").encode()), n := len(ids_of(tokenizers[WORDS], b)), n > 2048) for a, b in ODD_ROWS), key=repr)
    for chunk in (32_000, 900):
        got = token_counts.token_counts(odd, tokenizer_file(WORDS), chunk=chunk, overlap=50)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == expected
    assert token_counts.token_counts(none, tokenizer_file(WORDS)).count() == 0


def test_segments_round_trip():
    choose = random.Random(2)
    for _ in range(200):
        value = lambda: choose.choice([0, 1, 5, 2**32 - 1, choose.randrange(50_000)])
        documents = [
            (choose.choice([None, -5, 7, 2**62]), np.array([value() for _ in range(choose.choice([0, 1, 127, 128, 129, 300]))], "<u4").tobytes())
            for _ in range(choose.randint(0, 6))
        ]
        image = token_files.encode_segment(documents, percentile=choose.choice([0, 50, 95, 100]), block=choose.choice([1, 64, 128]))
        assert [(a, b.tobytes()) for a, b in token_files.decode_segment(image)] == documents
        every = np.frombuffer(b"".join(b for _, b in documents), "<u4")
        for _ in range(3):
            start = choose.randint(0, len(every))
            n = choose.randint(0, len(every) - start)
            assert (token_files.read_tokens(image, start, n) == every[start : start + n]).all()
    with pytest.raises(ValueError):
        list(token_files.decode_segment(b"nope" + bytes(12)))


def test_token_files(spark, tokenizers, odd, none, tmp_path):
    token_files.write_tokens(odd, f"{tmp_path}/a", tokenizer_file(BYTES), segment_tokens=300, shard_bytes=40_000)
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read_documents(spark, f"{tmp_path}/a").collect()))
    ordered, start = sorted(ODD_ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())), 0
    assert len(got) == len(ordered)
    for (a, b), row in zip(ordered, got):
        ids = [*ids_of(tokenizers[BYTES], b), 2]
        assert row == (start, a, len(ids), crc(ids))
        start += len(ids)
    token_files.write_tokens(none, f"{tmp_path}/b", tokenizer_file(BYTES))
    assert token_files.read_documents(spark, f"{tmp_path}/b").count() == 0


def check_plan(counts, capacity):
    runs, places, pieces = packing.plan(counts, capacity), defaultdict(list), set()
    for length, first, last, sequence, each, offset in runs:
        for number in range(first, last):
            places[sequence + (number - first) // each].append((offset + (number - first) % each * length, length))
            pieces.add((length, number))
    assert len(pieces) == sum(counts.values()) == sum(map(len, places.values()))
    for found in places.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


def test_plans_are_gapless_and_exact_where_they_can_be():
    choose = random.Random(1)
    for _ in range(200):
        capacity = choose.choice([8, 16, 50, 200])
        check_plan({n: choose.randint(0, 40) for n in range(1, capacity + 1) if choose.random() < choose.choice([0.1, 0.5, 1])}, capacity)
    assert check_plan({}, 8) == 0
    assert check_plan({8: 3, 5: 4, 3: 4}, 8) == 7  # pairs
    assert check_plan({4: 2, 3: 2, 1: 2}, 8) == 2  # triples on top of a single
    assert check_plan({5: 6, 1: 6, 2: 6}, 8) == 6
    assert check_plan({3: 4}, 8) == 2 and check_plan({1: 17}, 8) == 3 and check_plan({2: 4}, 8) == 1


def check_pieces(rows, documents, tokenizer, capacity):
    by_document, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_document[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, text in documents:
        ids, end = [*ids_of(tokenizer, text), 0], 0
        for k, r in enumerate(sorted(by_document[doc_id], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, end, crc(ids[end : end + r["length"]]))
            assert k == 0 or r["length"] == capacity
            end += r["length"]
        assert end == len(ids)
    for found in sequences.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_packing(odd, none, documents, tokenizers, monkeypatch):
    unique = [row for row in ODD_ROWS if row[0] not in (None, 3)]
    rows = packing.packed(odd.filter("doc_id is not null and doc_id <> 3"), tokenizer_file(BYTES)).collect()
    check_pieces(rows, unique, tokenizers[BYTES], 2048)
    every = packing.packed(odd, tokenizer_file(BYTES), 100, with_ids=True).collect()
    assert sum(r["length"] for r in every) == sum(len(ids_of(tokenizers[BYTES], b)) + 1 for _, b in ODD_ROWS)
    assert len({(r["sequence_id"], r["offset"]) for r in every}) == len(every) and all(len(r["ids"]) == 4 * r["length"] for r in every)
    assert packing.packed(none, tokenizer_file(BYTES)).count() == 0
    monkeypatch.setattr(packing, "GROUP", 50)  # many salted groups per length
    pairs = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    n = check_pieces(packing.pack(packing.cut_lineage(packing.pieces(documents, tokenizer_file(BYTES), 512)), 512, group=50).collect(), pairs, tokenizers[BYTES], 512)
    total = sum(len(ids_of(tokenizers[BYTES], b)) + 1 for _, b in pairs)
    assert n <= -(-total // 512) * 1.02


def test_encoder_divides_parts_as_the_library_does():
    """Contractions, line breaks, special strings and every character around the Latin ones."""
    draw = random.Random(3)
    bits = ["a", "B", "é", "ß", "'s", "'ll", "'", " ", "  ", "\n", "\t", "\r\n", "1", "²", "ª", "\u00ad", ",", "!?", "—", "日本", "\xa0", "\x1c", "\x85", "<|endoftext|>", " the", "\0", "\u3000", "😀"]
    texts = ["".join(draw.choices(bits, k=draw.randint(1, 25))) for _ in range(5000)]
    texts += [chr(c) + w + " x" + chr(c) for c in range(1, 0x260) for w in ("a", "1", " ", "'s")]
    path = tokenizer_file("byte_bpe_50k.json")
    expected = load_tokenizer(path).encode_batch(texts, add_special_tokens=False)
    assert Encoder(path).ids(texts) == [np.array(e.ids, "<u4").tobytes() for e in expected]


def test_latin_texts_are_looked_up_by_pieces_alone(tokenizers):
    """Parts recur less than pieces do: a word with each sign after it is a part of its own."""
    texts = [odd_text(k, 40).encode("latin-1", "ignore").decode("latin-1") for k in range(1500)] + [a + b + " x\n" + a for a in ("it's", " né", "1") for b in ",.;:!"]
    texts = [t for t in texts if not any(c in t for c in "\0\x1c\x85") and "<|endoftext|>" not in t]
    coder = Encoder(tokenizer_file(BYTES))
    assert [np.frombuffer(b, "<u4").tolist() for b in coder.ids(texts)] == [ids_of(tokenizers[BYTES], t) for t in texts]
    assert len(texts) > 100 and not coder.parts  # no part was looked up
    assert len(coder.ids(["a\u0416 b"])[0]) == 4 * len(ids_of(tokenizers[BYTES], "a\u0416 b")) and len(coder.parts) == 2


def test_images_are_not_shuffled(spark, odd, tmp_path):
    """Only their places are sent to them, whatever the planner takes the sizes for."""
    token_files.write_tokens(odd, f"{tmp_path}/a", tokenizer_file(BYTES), segment_tokens=300, shard_bytes=40_000)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = token_files.read_documents(spark, f"{tmp_path}/a")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and not any("image" in line for line in plan.split("\n") if "Sort [" in line)
        assert got.count() == len(ODD_ROWS)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_worker_remembers_for_one_kind_of_operator_at_a_time():
    path = tokenizer_file("byte_bpe_50k.json")
    known = W.word_hashes()
    assert W.word_hashes() is known and W.word_hashes(1) is not known and W.word_hashes(0) is known
    gone = weakref.ref(known)
    del known
    coder = encoder(path)
    assert gone() is None and encoder(path) is coder
    gone = weakref.ref(coder)
    del coder
    counted_parts(path)
    assert gone() is None
