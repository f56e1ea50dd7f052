"""Encoding against the library, and unigram counts against all segmentations."""

import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from gabarito.llm.pieces import Encoder, encode_texts
from gabarito.llm.queries import PIECES
from gabarito.llm.token_counts import MARK, Trie, Unigram, count_tokens

RAW = open(PIECES, "rb").read()
TEXTS = [
    None, "", " ", "   ", "  a  b\n▁c \x00�", "▁▁ a▁", "<s> <unk> <0x0A>", "日本 語", "é€😀 ñ", "hello hello", "hello hello",
    "a" * 3000, "\t x  ", "word " * 20_000,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=RAW)


def test_encoding_equals_library(docs_of, library):
    rows = list(enumerate(TEXTS))
    found = {r["doc_id"]: (r["ids"], r["decoded"]) for r in encode_texts(docs_of(rows), PIECES).collect()}
    assert found == {i: (library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in rows}


def test_random_texts_equal_library(library):
    rng, encoder = random.Random(2), Encoder(RAW)
    texts = ["".join(rng.choice("ab the in\n▁<>0é日x  QZ") for _ in range(rng.randrange(90))) for _ in range(2000)]
    assert encoder.encode(texts) == library.encode(texts)


def test_long_and_short_agendas_agree():
    rng, vocabulary = random.Random(4), Encoder(RAW).vocabulary
    for _ in range(500):
        part = "".join(rng.choice("aehinorst") for _ in range(rng.randrange(1, 40)))
        assert vocabulary.merge_long(part) == vocabulary.merge_short(part)


def test_a_difference_fails():
    encoder = Encoder(RAW)
    encoder.vocabulary.merge_short = list
    with pytest.raises(ValueError, match="differ"):
        encoder.encode(["the thing"])


def test_clashing_columns_and_empty_table(docs_of):
    df = docs_of([(1, "a b")]).withColumns({"IDS": F.lit(1), "n_tokens": F.lit(1)})
    assert encode_texts(df, PIECES).first()["ids"] == [264, 287]
    assert count_tokens(df, PIECES).first()["n_tokens"] == 2
    assert encode_texts(docs_of([]), PIECES).count() == count_tokens(docs_of([]), PIECES).count() == 0


def best_counts(word, model, scores):
    """Token counts of the best segmentations, by trying all of them from the left."""
    best = {0: (0.0, {0})}
    for end in range(1, len(word) + 1):
        options = [(best[b][0] + scores[word[b:end]], {n + 1 for n in best[b][1]}) for b in range(end) if word[b:end] in scores]
        if word[end - 1] not in scores:
            options.append((best[end - 1][0] + model.unknown, {n + model.unknown_tokens(word[end - 1]) for n in best[end - 1][1]}))
        top = max(s for s, _ in options)
        best[end] = (top, set().union(*(n for s, n in options if s == top)))
    return best[len(word)]


def test_counts_are_of_a_best_segmentation(docs_of, library):
    model, rng = Unigram(RAW), random.Random(6)
    scores = {library.id_to_piece(i): library.get_score(i) for i in range(library.get_piece_size()) if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))}
    words = sorted({MARK + "".join(rng.choice("aehinorst,.\né") for _ in range(rng.randrange(1, 14))) for _ in range(1500)})
    trie = Trie(model)
    trie.insert(words)
    for word in words:
        assert trie.terminal[word] in best_counts(word, model, scores)[1]


def test_counts_equal_the_library_as_unigram():
    """The library's lattice over the same pieces, where its two best differ in score."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(RAW)
    proto.trainer_spec.model_type = 1
    lattice = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("aehinorst") for _ in range(rng.randrange(2, 12))) for _ in range(400)})
    trie = Trie(Unigram(RAW))
    trie.insert([MARK + w for w in words])
    compared = 0
    for word in words:
        first, *others = [sum(map(lattice.get_score, ids)) for ids in lattice.nbest_encode_as_ids(word, 2)]
        if not others or others[0] < first:
            assert trie.terminal[MARK + word] == len(lattice.nbest_encode_as_ids(word, 2)[0]), word
            compared += 1
    assert compared > 300


def test_counts_of_whole_texts(docs_of):
    rows = list(enumerate(TEXTS))
    found = {r["doc_id"]: (r["n_pretokens"], r["n_tokens"]) for r in count_tokens(docs_of(rows), PIECES).collect()}
    assert found[0] == found[1] == (0, 0) and found[9] == found[10]
    assert found[13][0] == 20_001 and found[2] == (1, 1)


def test_order_and_batches_do_not_matter():
    rng = random.Random(9)
    texts = ["".join(rng.choice("abc de\n") for _ in range(60)) for _ in range(200)]
    whole = Trie(Unigram(RAW)).count(texts)
    piecewise = Trie(Unigram(RAW))
    assert [piecewise.count([t])[0] for t in reversed(texts)][::-1] == whole
