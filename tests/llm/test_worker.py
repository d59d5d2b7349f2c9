import numpy as np
import public_tokenizers

from vigilake.llm import language_id, packing, texts


def test_a_worker_keeps_only_what_its_stage_asked_for():
    """Processes outlive their stage: the tokenizer's words must not stay beside the language model's tables."""
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = packing.token_ids(path)
    assert packing.token_ids(path) is encoder
    given = {"en": b"the and of to in is that it " * 40, "de": b"der die das und ist nicht ein " * 40}
    model = language_id.language_model(given)
    assert language_id.language_model(dict(reversed(given.items()))) is model and len(texts._HELD) == 1
    assert language_id.language_model(given | {"de": b"le la les et est " * 40}) is not model
    assert packing.token_ids(path) is not encoder and len(texts._HELD) == 1


def test_words_learned_together_have_the_library_s_ids():
    encoder = packing.TokenIds(public_tokenizers.path("word_bpe_49k.json"))
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdeéßñ語́I.,9%"), size=rng.integers(1, 9))) for _ in range(600)]
    lines = [" ".join(rng.choice(words, size=40)) for _ in range(60)] + ["", " ", ".", ",.", "a.", "a..", "<|x|>. a,"]
    assert encoder.encode(lines) == encoder._encode(lines)
    assert encoder.encode(lines) == encoder._encode(lines)


def test_words_that_come_again_stay_where_memory_ends(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_ENTRIES", 30)
    encoder = packing.TokenIds(public_tokenizers.path("word_bpe_49k.json"))
    lines = ["common alpha beta", "common common, gamma&&& a|b", " ".join(f"w{i}x" for i in range(25)), "common gamma&&& 'll| |"]
    for line in lines:
        assert encoder.encode([line]) == encoder._encode([line])
        assert "common" in encoder.memo
    assert "alpha" not in encoder.memo


def test_a_task_hands_its_memory_back_when_it_ends(monkeypatch):
    ends = []
    monkeypatch.setattr(texts, "give_back", lambda: ends.append(1))
    rows = texts.giving_back(iter([1, 2]))
    assert next(rows) == 1 and not ends
    assert list(rows) == [2] and len(ends) == 1


def test_kept_rows_send_their_text_once(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None), (None, "Ä\x00"), (1, "a")], "doc_id long, text string")
    kept = texts.keep_rows(docs, lambda: lambda text: text in (b"", "Ä\x00".encode()))
    assert sorted(kept.collect(), key=str) == sorted([(2, None), (None, "Ä\x00")], key=str)
    assert "cast(text" not in kept._jdf.queryExecution().toString()
    other = docs.selectExpr("doc_id", "cast(text as binary) as text")
    assert sorted(texts.keep_rows(other, lambda: lambda text: text == b"a").toPandas()["doc_id"]) == [1, 1]
