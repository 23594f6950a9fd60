import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidewater.llm import packing as K
from tidewater.llm.queries import REGISTRY

from .helpers import odd_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_ids(texts):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]


def test_encoder_equals_tokenizer():
    r = random.Random(2)
    texts = ["", " ", "  x", "a  b\n c \n\nd  \t e ", "x \n y", "it's 12  34é q's", "<|endoftext|> a", "漢字 かな 🙂🙂 z", "a  b  c", "tab\t \there"]
    texts += ["".join(r.choice(["a", "B", " ", "  ", "\n", "'s", ".", "9", "é", "\t", "word", " "]) for _ in range(40)) for _ in range(400)]
    mine = K.Encoder(PATH)
    for text, ids in zip(texts, plain_ids(texts)):
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == ids[:-1], text


def best_fit(lengths, capacity):
    room = []
    for x in sorted(lengths, reverse=True):
        fit = min((i for i, f in enumerate(room) if f >= x), key=lambda i: room[i], default=None)
        if fit is None:
            room.append(capacity - x)
        else:
            room[fit] -= x
    return len(room)


def test_plan_uses_every_length_once():
    r = random.Random(3)
    for n, top in ((0, 9), (1, 2048), (50, 2048), (3000, 2048), (3000, 700), (400, 40)):
        lengths = [r.randint(1, top) for _ in range(n)]
        made = K.plan(dict(Counter(lengths)))
        used = Counter()
        for times, row in made:
            assert times > 0 and sum(row) <= 2048
            for x in row:
                used[x] += times
        assert used == Counter(lengths)
        assert sum(t for t, _ in made) <= 1.02 * best_fit(lengths, 2048) + 1


def test_patterns_fill_a_sequence():
    forms = K.patterns(24, 3)
    assert (forms.sum(axis=1) == 24).all() and len({tuple(f) for f in forms}) == len(forms) == 61


def check_packing(rows, texts):
    """``texts``: doc_id to text, each id once."""
    ids = dict(zip(texts, plain_ids(texts.values())))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for doc_id, own in pieces.items():
        own.sort(key=lambda r: r.piece)
        at = 0
        for n, r in enumerate(own):
            part = ids[doc_id][r.start : r.start + r.length]
            assert r.piece == n and r.start == at and zlib.crc32(np.asarray(part, "<u4").tobytes()) == r.ids_crc32
            assert r.length == 2048 or n == 0
            at += r.length
        assert at == len(ids[doc_id])
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences)


def test_query(spark, sf):
    rows = REGISTRY["op2_best_fit_packing"](spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    n = check_packing(rows, texts)
    assert n <= best_fit([r.length for r in rows], 2048) * 1.01 + 1


def test_odd_rows_and_a_common_length(spark):
    docs = odd_documents(spark, ["same length here"] * 500).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = K.packed(K.tokenised_pieces(docs, PATH)).collect()
    check_packing(rows, {r.doc_id: r.text for r in docs.collect()})
    assert K.packed(K.tokenised_pieces(docs.limit(0), PATH)).count() == 0
    assert K.packed(K.tokenised_pieces(odd_documents(spark), PATH)).where("doc_id IS NULL").count() == 1


def test_a_worker_holds_few_words_and_a_slice_of_a_batch(monkeypatch):
    """The encoder's memory stays bounded however many words it meets, and forgetting them changes no ids."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert K._CACHE_WORDS <= 100_000 and K._ROWS_AT_ONCE <= 1_000
    texts = [" ".join(f"word{i}x, odd{i % 7} and" for i in range(k, k + 60)) for k in range(0, 600, 40)]
    whole = K.Encoder(path)
    want = [whole.encode(t) for t in texts]
    monkeypatch.setattr(K, "_CACHE_WORDS", 20)
    small = K.Encoder(path)
    assert [small.encode(t) for t in texts] == want
    assert len(small) <= 22 and len(small.ids) <= 26


def test_slices_of_a_batch_give_all_pieces(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(["some words"] * (i % 50))) for i in range(2_500)], "doc_id long, text string").coalesce(1)
    got = K.tokenised_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=32)
    pieces = got.groupBy("doc_id").sum("length").collect()
    assert len(pieces) == 2_500 and got.agg({"length": "max"}).first()[0] <= 32


def test_words_in_use_are_remembered_when_the_dictionary_is_full(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(K, "_CACHE_WORDS", 20)
    mine = K.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    asked, tokenize = [], mine.tokenize
    mine.tokenize = lambda signs: asked.append(signs) or tokenize(signs)
    # a word met again and again between others that fill the dictionary many times over
    rare = ["".join(chr(97 + int(d)) for d in f"{i:04}") for i in range(300)]
    text = "x " + " often ".join(rare) + " often, often."
    assert mine.encode(text) == b"".join(K.np.asarray([t], "<u4").tobytes() for t in _ids(text))
    assert asked.count(K._BLANK_SIGN + "often") == 1
    assert len(mine) <= 20 and len(mine.older) <= 20 and "often," not in mine


def _ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids


def test_stops_and_line_ends_are_parted_from_words_only_where_they_are_pre_tokens():
    texts = ["One, two. Three.\nFour, five\nsix. ", "a.\nb,\nc. d", "x!, y", "x_, y", "x!.\nA", "é, 漢. ²,\n9. z", "a\r\nb", "a\u3000\nb", "a\n\nb", "a\n b", "\na", "a\n", ". a", ", ", "a., b", "a\n. b"]
    texts += ["\0, a", "a \0, b", "a\0. b\nc", "e\u0301, x", "the, the. the,\nThe.\nthe", "\x1c\na, b"]
    r = random.Random(4)
    texts += ["".join(r.choice(["a", "Bc", "é", "9", "_", "!", ", ", ". ", ",", ".", " ", "\n", "\r", "\0"]) for _ in range(30)) for _ in range(2000)]
    mine = K.Encoder(PATH)
    for text, ids in zip(texts, plain_ids(texts)):
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == ids[:-1], text


def test_words_before_a_stop_are_found_without_a_call(monkeypatch):
    mine = K.Encoder(PATH)
    calls, missing = [], K.Encoder.__missing__
    monkeypatch.setattr(K.Encoder, "__missing__", lambda self, word: calls.append(word) or missing(self, word))
    mine.encode("a word, a word.\na word, a word, a word. A word " * 50 + "x")
    assert len(calls) < 12
