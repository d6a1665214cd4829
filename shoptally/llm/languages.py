"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a word is the sum over
all its segmentations into pieces, computed by a forward pass; expectation-maximisation over the counted words of the
training texts fits the piece probabilities with expected counts from a forward-backward pass. A text is scored by the sum
of its words' log-probabilities in each language.

Words are whole runs of letters, lower-cased, with a word-start mark, and every piece of the vocabulary that letters can
make up takes part, however long. A letter that is no piece itself may be covered by a stand-in piece. Passes run over many
words of one length at once; words of more than ``SHORT`` letters, whose probability could vanish, in logarithms.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptally.llm.common import part_count, table
from shoptally.session import checkpointed

SHORT = 20
ROUNDS = 2
SMOOTHING = 0.1
CACHED = 300_000
CACHED_LETTERS = 16 * CACHED
GROUP_LETTERS = 480_000  # letters of the words that one pass takes together
LETTER_BITS = 21  # of a code point
MARK = "▁"
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def words_in(text: str) -> list[str]:
    """Letter runs of a text in lower case."""
    return _LETTERS.findall(text.lower())


class PrefixTree:
    """Numbered texts as arrays: sorted edge keys (node, letter), the node behind each edge, the text that ends at each node."""

    def __init__(self, numbers: dict[str, int]):
        nodes, edges, ends = {"": 0}, {}, [-1]
        for text in numbers:
            for size in range(1, len(text) + 1):
                prefix = text[:size]
                if prefix not in nodes:
                    nodes[prefix] = len(ends)
                    ends.append(numbers.get(prefix, -1))
                    edges[nodes[prefix[:-1]] << LETTER_BITS | ord(prefix[-1])] = nodes[prefix]
        keys = sorted(edges)
        self.keys = np.array([*keys, np.iinfo(np.int64).max], dtype=np.int64)  # a search never runs off the end
        self.behind = np.array([edges[k] for k in keys], dtype=np.int64)
        self.ends = np.array(ends, dtype=np.int32)
        self.longest = max(map(len, numbers))


class Pieces:
    """The pieces of a vocabulary file that can make up words, numbered; number 0 is the stand-in."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
        texts = dict.fromkeys(model.id_to_piece(i).lower() for i in usable)
        spelled = (t for t in texts if t == MARK or _LETTERS.fullmatch(t.removeprefix(MARK)))
        self.numbers = {t: n for n, t in enumerate(spelled, 1)}
        self.count = len(self.numbers) + 1

    def spans(self, words: list[str]) -> np.ndarray:
        """For marked words of one length n: piece number of each (word, length - 1, start), -1 where no piece fits.

        All starts of all words walk down the prefix tree together; those whose letters begin no piece drop out.
        """
        if not hasattr(self, "tree"):  # the driver needs none
            self.tree = PrefixTree(self.numbers)
        tree = self.tree
        n = len(words[0])
        letters = np.array(words, dtype=f"U{n}").view(np.uint32).reshape(len(words), n).astype(np.int64)
        out = np.full((len(words), min(n, tree.longest), n), -1, dtype=np.int32)
        word, start = np.divmod(np.arange(letters.size), n)
        node = np.zeros(letters.size, dtype=np.int64)
        for size in range(1, out.shape[1] + 1):
            inside = start + size <= n
            word, start, node = word[inside], start[inside], node[inside]
            key = node << LETTER_BITS | letters[word, start + size - 1]
            at = np.searchsorted(tree.keys, key)
            known = tree.keys[at] == key
            word, start, node = word[known], start[known], tree.behind[at[known]]
            out[word, size - 1, start] = tree.ends[node]
        single = out[:, 0, :]
        single[single < 0] = 0
        return out


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def forward(spans: np.ndarray, probability: np.ndarray) -> np.ndarray:
    """Prefix probabilities (n + 1, words, languages); ``probability`` is (pieces + 1, languages) and ends in a row of zeros."""
    n = spans.shape[2]
    at = np.zeros((n + 1, len(spans), probability.shape[1]))
    at[0] = 1.0
    for end in range(1, n + 1):
        for size in range(1, min(end, spans.shape[1]) + 1):
            at[end] += at[end - size] * probability[spans[:, size - 1, end - size]]
    return at


def log_forward(spans: np.ndarray, logs: np.ndarray, backward=False) -> np.ndarray:
    """``forward`` in logarithms, for words of any length; or the probabilities of what follows each place."""
    n = spans.shape[2]
    at = np.empty((n + 1, len(spans), logs.shape[1]))
    at[n if backward else 0] = 0.0
    for step in range(1, n + 1):
        sizes = np.arange(1, min(step, spans.shape[1]) + 1)
        here = n - step if backward else step
        starts = np.full_like(sizes, here) if backward else here - sizes
        terms = logs[spans[:, sizes - 1, starts].T] + at[here + sizes if backward else starts]
        most = terms.max(axis=0)
        at[here] = most + np.log(np.exp(terms - most).sum(axis=0))
    return at


def _logs(probability: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(probability)


def expected_counts(spans: np.ndarray, weights: np.ndarray, probability: np.ndarray, out: np.ndarray, short=SHORT) -> None:
    """Add to ``out (pieces, languages)`` how often each piece is used; ``weights`` are the words' counts in each language."""
    n = spans.shape[2]
    if n > short + 1:
        logs = _logs(probability)
        ahead, back = log_forward(spans, logs), log_forward(spans, logs, backward=True)
    else:
        ahead = forward(spans, probability)
        back = np.zeros_like(ahead)
        back[n] = 1.0
        for start in range(n - 1, -1, -1):
            for size in range(1, min(n - start, spans.shape[1]) + 1):
                back[start] += probability[spans[:, size - 1, start]] * back[start + size]
        scale = weights / np.maximum(ahead[n], 1e-300)
    for start in range(n):
        for size in range(1, min(n - start, spans.shape[1]) + 1):
            piece = spans[:, size - 1, start]
            used = np.flatnonzero(piece >= 0)
            if len(used):
                p = piece[used]
                if n > short + 1:
                    share = np.exp(ahead[start, used] + logs[p] + back[start + size, used] - ahead[n, used]) * weights[used]
                else:
                    share = (ahead[start, used] * probability[p] * back[start + size, used]) * scale[used]
                np.add.at(out, p, share)


def _by_length(words) -> dict[int, list[int]]:
    groups = defaultdict(list)
    for i, w in enumerate(words):
        groups[len(w)].append(i)
    return groups


def _parts(group: list[int], length: int) -> Iterator[list[int]]:
    """A group of words of one length in parts of at most ``GROUP_LETTERS`` letters, or one word."""
    step = max(1, GROUP_LETTERS // length)
    return (group[at : at + step] for at in range(0, len(group), step))


def log_probabilities(words: list[str], probability: np.ndarray, known: Pieces) -> np.ndarray:
    """(words, languages) log-probability of unmarked words, all segmentations summed."""
    out = np.empty((len(words), probability.shape[1]))
    marked = [MARK + w for w in words]
    logs = _logs(probability)
    for length, group in _by_length(marked).items():
        for part in _parts(group, length):
            spans = known.spans([marked[i] for i in part])
            if length > SHORT + 1:
                out[part] = log_forward(spans, logs)[-1]
            else:
                out[part] = np.log(np.maximum(forward(spans, probability)[-1], 1e-300))
    return out


def count_words(labelled: DataFrame) -> DataFrame:
    """``(lang, word, n)`` over all rows of ``labelled (text, lang)``; counts are summed in each batch before the shuffle."""

    def run(batches):
        for batch in batches:
            counts: dict[str, Counter] = defaultdict(Counter)
            for text, lang in zip(batch.text, batch.lang, strict=True):
                counts[lang].update(words_in(text))
            for lang, found in counts.items():
                yield pd.DataFrame({"lang": lang, "word": list(found), "n": list(found.values())})

    usable = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    return usable.mapInPandas(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Model:
    """Languages in order and the probability of each piece in each (pieces, languages)."""

    def __init__(self, langs: list[str], probability: np.ndarray):
        self.langs, self.probability = langs, probability

    def padded(self) -> np.ndarray:
        return np.vstack([self.probability, np.zeros((1, len(self.langs)))])


def train(labelled: DataFrame, path: str, rounds=ROUNDS) -> Model:
    """Piece probabilities of every language in ``labelled (text, lang)``, from all its rows.

    Expected counts are summed by Spark; what reaches the driver is one number per piece and language.
    """
    spark = labelled.sparkSession
    counted = checkpointed(count_words(labelled))
    langs = sorted(r[0] for r in counted.select("lang").distinct().collect())
    known = pieces(path)
    model = Model(langs, np.full((known.count, max(1, len(langs))), 1.0 / known.count))
    if not langs:
        return Model([], np.zeros((known.count, 0)))
    number = {lang: i for i, lang in enumerate(langs)}
    dealt = counted.repartition(part_count(spark), "word")

    for _ in range(rounds):
        padded = model.padded()

        def run(batches, padded=padded):
            total = None
            for batch in batches:
                vocabulary = pieces(path)
                if total is None:
                    total = np.zeros((vocabulary.count, len(number)))
                wide = batch.pivot_table(index="word", columns="lang", values="n", aggfunc="sum", fill_value=0)
                weights = np.zeros((len(wide), len(number)))
                for lang in wide.columns:
                    weights[:, number[lang]] = wide[lang]
                marked = [MARK + w for w in wide.index]
                for length, group in _by_length(marked).items():
                    for part in _parts(group, 2 * length):
                        expected_counts(vocabulary.spans([marked[i] for i in part]), weights[part], padded, total)
            if total is not None:
                piece, lang = np.nonzero(total)
                yield pd.DataFrame({"piece": piece, "lang": lang, "n": total[piece, lang]})

        sums = dealt.mapInPandas(run, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        counts = np.full((known.count, len(langs)), SMOOTHING)
        np.add.at(counts, (sums.piece.to_numpy(), sums.lang.to_numpy()), sums.n.to_numpy())
        model = Model(langs, counts / counts.sum(axis=0))
    return model


class Scorer:
    """Scores texts; the words of earlier texts are remembered, up to ``CACHED`` words and ``CACHED_LETTERS`` letters."""

    def __init__(self, model: Model, path: str):
        self.model, self.known, self.padded = model, pieces(path), model.padded()
        self.rows: dict[str, int] = {}
        self.letters = 0
        self.table = np.zeros((0, len(model.langs)))

    def batch(self, texts) -> list[tuple[str, float]]:
        out = []
        for at in range(0, len(texts), 500):
            out += self._some(texts[at : at + 500])
        return out

    def _some(self, texts):
        split = [words_in(t) if t and any(map(str.isalpha, t)) else None for t in texts]
        if len(self.rows) > CACHED or self.letters > CACHED_LETTERS:
            self.rows, self.table, self.letters = {}, self.table[:0], 0
        new = list(dict.fromkeys(w for words in split if words for w in words if w not in self.rows))
        if new:
            self.letters += sum(map(len, new))
            self.rows.update(zip(new, range(len(self.table), len(self.table) + len(new)), strict=True))
            self.table = np.vstack([self.table, log_probabilities(new, self.padded, self.known)])
        return [self._one(words) for words in split]

    def _one(self, words) -> tuple[str, float]:
        if words is None or not self.model.langs:
            return UNKNOWN, 0.0
        total = self.table[[self.rows[w] for w in words]].sum(axis=0)
        share = np.exp(total - total.max())
        best = int(np.argmax(share))
        return self.model.langs[best], float(share[best] / share.sum())


def predict(docs: DataFrame, model: Model, path: str) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row; ``und`` and 0 for null texts and texts without a letter.

    The score is the probability of the predicted language given the text, all languages being equally likely before.
    Nothing but the text enters. Repeated rows are predicted each; an empty table gives an empty result.
    """

    @F.pandas_udf("lang_pred string, score double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model, path)
        for texts in batches:
            found = scorer.batch(list(texts))
            yield pd.DataFrame({"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]})

    return docs.select("doc_id", scored("text").alias("r")).select("doc_id", "r.*")


def held_out(doc_id="doc_id"):
    """True for the quarter of the documents that training never sees; a missing id is trained on."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def piece_path(name="piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_languages(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out()), piece_path())
    found = predict(docs.select("doc_id", "text"), model, piece_path())
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


QUERIES = {"op9_languages": op9_languages}
