"""Pieces and words of any length: logarithmic passes against the plain ones, and whole runs of letters."""

import numpy as np
import pytest

from shoptally.llm import languages


@pytest.fixture(scope="module")
def known():
    return languages.pieces(languages.piece_path())


@pytest.fixture(scope="module")
def probability(known):
    rng = np.random.default_rng(2)
    made = rng.random((known.count, 3)) ** 6 + 1e-6
    return np.vstack([made / made.sum(axis=0), np.zeros((1, 3))])


def test_every_spelled_piece_takes_part(known):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=languages.piece_path())
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    spelled = {p for p in pieces if p.removeprefix(languages.MARK).isalpha()}
    assert spelled <= set(known.numbers) and max(map(len, spelled)) > 12
    longest = max(spelled, key=len)
    found = known.spans([longest])
    assert found[0, len(longest) - 1, 0] == known.numbers[longest]


def _all_segmentations(text, known, p):
    total = np.zeros(p.shape[1])

    def walk(at, product):
        nonlocal total
        if at == len(text):
            total += product
        for end in range(at + 1, len(text) + 1):
            number = known.numbers.get(text[at:end], 0 if end == at + 1 else None)
            if number is not None:
                walk(end, product * p[number])

    walk(0, np.ones(p.shape[1]))
    return total


@pytest.mark.parametrize("word", ["distribution", "a", "straße", "ñandú"])
def test_sum_over_all_segmentations(known, probability, word):
    want = np.log(_all_segmentations(languages.MARK + word, known, probability))
    assert languages.log_probabilities([word], probability, known)[0] == pytest.approx(want)
    logs = languages.log_forward(known.spans([languages.MARK + word]), languages._logs(probability))
    assert logs[-1, 0] == pytest.approx(want)


def test_both_passes_expect_the_same_counts(known, probability):
    spans = known.spans([languages.MARK + w for w in ("communications", "distributionen")])
    weights = np.array([[1.0, 2.0, 0.0], [3.0, 0.5, 1.0]])
    plain, logarithmic = np.zeros((known.count, 3)), np.zeros((known.count, 3))
    languages.expected_counts(spans, weights, probability, plain)
    languages.expected_counts(spans, weights, probability, logarithmic, short=1)
    assert plain == pytest.approx(logarithmic) and plain.sum() > 0


def test_a_run_of_many_letters_is_one_word(known, probability):
    run = "information" * 400
    assert languages.words_in("x " + run.upper()) == ["x", run]
    value = languages.log_probabilities([run, "x"], probability, known)
    assert np.isfinite(value).all() and (value[0] < -745).all()  # below the smallest double
    double = languages.log_probabilities([run + run], probability, known)[0]
    assert double == pytest.approx(2 * value[0], rel=0.02)
    counts = np.zeros((known.count, 3))
    languages.expected_counts(known.spans([languages.MARK + run]), np.ones((1, 3)), probability, counts)
    length = np.ones(known.count)
    for text, number in known.numbers.items():
        length[number] = len(text)
    assert (counts * length[:, None]).sum(axis=0) == pytest.approx(np.full(3, len(run) + 1.0))  # each letter is used once


def test_scores_of_long_runs_and_empty_texts(spark, known, probability):
    model = languages.Model(["aa", "bb", "cc"], probability[:-1])
    rows = [(1, "wort " * 50), (2, "wort" * 3000), (3, ""), (4, None), (None, "12 ²"), (2, "wort" * 3000)]
    found = languages.predict(spark.createDataFrame(rows, "doc_id long, text string"), model, languages.piece_path()).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert [r.lang_pred for r in found][2:4] == ["und", "und"]
