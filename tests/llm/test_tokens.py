"""Token counts against the tokenizer's own library."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyquill.llm import transducer

PATH = public_tokenizers.path("word_bpe_49k.json")
AWKWARD = [
    "", " \n\t", "a", "don't 'sam ''s we'rex 'r", "'r", "'re", "x'", "'", ". 's \"'s", "I'LL 'LL 'lL'l", "ends with 'v", "<|endoftext|>a<|startoftext|>'s e<|endoftext|>́", "<|endoftext| >",
    "é ạ̇ 각", "İstanbul ſ K Å", "漢字かな 한국어", "😀😀 🇩🇪", "a\x00b\x00\x01", " 　 x\u0085y\x1c\x1d", "½ ² ٣ 12345", "a" * 5000, "ǆ Ǆ ß ẞ ΑΣ ς", "퟿\U0010ffff \U000e0001",
]


@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in own.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def made():
    return transducer.compiled(PATH)


def random_texts(n, seed):
    r = random.Random(seed)
    pools = ["abcdefghijklmnopqrstuvwxyz", "aeiourstlnm'' ", "'srtvlemd .,!0aA \n", "".join(map(chr, range(0xA0, 0x600))), "thein gan ", "".join(chr(r.randrange(0x20, 0xD000)) for _ in range(400)), "ȩ́ 가"]
    return ["".join(r.choices(r.choice(pools), k=r.randrange(1, 80))) for _ in range(n)]


def test_counts_are_the_librarys(made, library):
    texts = AWKWARD + random_texts(3000, 5)
    assert transducer.counted(texts, made).tolist() == library(texts)


def test_every_character_is_of_the_librarys_class(made, library):
    texts = [f"a{chr(c)}.{chr(c)}1" for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    assert transducer.counted(texts, made).tolist() == library(texts)


def test_long_texts_are_cut_where_nothing_changes(made, library, monkeypatch):
    text = " ".join(random_texts(400, 9))
    monkeypatch.setattr(transducer, "RUN_CHARS", 100)
    assert transducer.counted([text, "", text * 2], made).tolist() == library([text, "", text * 2])
    monkeypatch.setattr(transducer, "CHUNK", 5)
    assert transducer.counted([text], made).tolist() == library([text])
    for blank in "\t\n\r\u3000":
        own = text.replace(" ", blank)
        assert transducer.counted([own], made).tolist() == library([own])


def test_forgotten_transitions_are_found_again(made, library, monkeypatch):
    monkeypatch.setattr(transducer, "TRANSITIONS", 50)
    monkeypatch.setattr(transducer, "PIECES", 3)
    texts = random_texts(200, 3)
    assert transducer.counted(texts, made).tolist() == library(texts)


def test_composed_maps_equal_one_state_after_the_other(made):
    r = random.Random(2)
    p = made.pieces
    classes = [r.randrange(p.width) + (p.width if r.random() < 0.05 else 0) for _ in range(3000)] + [transducer.SPACE]
    begins, state = [], p.BETWEEN
    for i, c in enumerate(classes):
        marks, state = int(p.marks[state, c]), int(p.next[state, c])
        begins.append(bool(marks & 1))
        if marks & 2:
            begins[i - 1] = True
    assert p.begins(transducer.np.array(classes)).tolist() == begins


def test_rows_of_any_kind(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Two words", None), (3, "Two words", None), (None, "no id", "y"), (5, "long " * 300_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = transducer.token_counts(df, PATH).collect()
    texts = [t or "" for _, t, _ in rows]
    want = [(i, len(t.encode()), n, n > 2048) for (i, _, _), t, n in zip(rows, texts, library(texts))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert transducer.token_counts(df.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        transducer.compiled(public_tokenizers.path("byte_bpe_50k.json"))


def test_query_is_whole(spark, library):
    from tallyquill.llm.queries import QUERIES
    from tests.sameness import SF

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op11_token_transducer"](spark, str(SF)).collect()}
    assert {i: r.n_tokens for i, r in got.items()} == dict(zip(docs, library(list(docs.values()))))
    assert all(got[i].n_bytes == len(t.encode()) and got[i].over_limit == (got[i].n_tokens > 2048) for i, t in docs.items())
