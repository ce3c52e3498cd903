"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary.
A word's probability in a language is the sum over all ways to cut it into
pieces of the product of their probabilities, which the forward algorithm
gives without listing the ways. Pieces never cross words, so a text's
log-probability is the sum over its words, and a word met before is looked up.

The probabilities are learnt by expectation maximisation: the words of a
bounded sample of labelled texts are counted by Spark, and each round's
expected piece counts are computed over these words in parallel. The model has
a row per piece and a column per language; it grows with neither table."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
#: Distinct labelled texts per language (about) that training takes, rounds, the weight
#: of the languages' common distribution in each, and its floor.
TRAINING_TEXTS, ROUNDS, PRIOR, FLOOR = 1500, 3, 200.0, 1e-3
#: Characters (the word's mark included) up to which words are taken side by side;
#: longer ones are taken one by one. Words in a worker's cache.
LONGEST_WORD, CACHE_WORDS = 24, 700_000
UNKNOWN = "und"
#: The least share of the best language among all with which the pipeline keeps a text.
LEAST_SHARE = 0.5

_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Runs of letters: A-Z in lower case, other ASCII characters as spaces."""
    return text.encode("utf-8", "replace").translate(_LETTERS).split()


@cache
def pieces(vocabulary: str = VOCABULARY) -> dict[str, int]:
    """Number of each piece of the vocabulary, from 1 on, and -1 for what only
    begins pieces. Number 0 stands for any other character."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=vocabulary)
    names = [sp.id_to_piece(k) for k in range(sp.get_piece_size()) if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k))]
    begun = {name[:k]: -1 for name in names for k in range(1, len(name))}
    return begun | {name: k for k, name in enumerate(names, 1)}


@cache
def n_pieces(vocabulary: str = VOCABULARY) -> int:
    return max(pieces(vocabulary).values()) + 1


def _edges(t: str, find) -> Iterator[tuple[int, int, int]]:
    """(begin, end, piece) of all pieces in a word; any single character is one."""
    n = len(t)
    for a in range(n):
        found = find(t[a])
        yield a, a + 1, found if found and found > 0 else 0
        if found is None:
            continue
        for b in range(a + 2, n + 1):
            found = find(t[a:b])
            if found is None:
                break
            if found > 0:
                yield a, b, found


class LongWord:
    """The pieces of one word of any length; probabilities as logarithms, as they
    may be smaller than any number."""

    def __init__(self, t: str, vocabulary: str):
        self.edges = np.array(list(_edges(t, pieces(vocabulary).get)), np.int64)
        self.n = len(t)

    def _lead(self, logs: np.ndarray, ends: int, begins: int, way: range) -> np.ndarray:
        """Logarithm of all that leads to each place, from one side."""
        order = np.argsort(self.edges[:, ends], kind="stable")
        at, source, piece = self.edges[order, ends], self.edges[order, begins], self.edges[order, 2]
        cuts = np.searchsorted(at, np.arange(self.n + 2))
        out = np.full((self.n + 1, logs.shape[1]), -np.inf)
        out[way.start - way.step] = 0
        for place in way:
            part = slice(cuts[place], cuts[place + 1])
            out[place] = np.logaddexp.reduce(out[source[part]] + logs[piece[part]], axis=0)
        return out

    def log_probability(self, p: np.ndarray) -> np.ndarray:
        return self._lead(np.log(p), 1, 0, range(1, self.n + 1))[-1]

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        logs = np.log(p)
        f, b = self._lead(logs, 1, 0, range(1, self.n + 1)), self._lead(logs, 0, 1, range(self.n - 1, -1, -1))
        begin, end, piece = self.edges.T
        shares = np.exp(f[begin] + logs[piece] + b[end] - f[-1]) * counts
        return np.stack([np.bincount(piece, x, len(p)) for x in shares.T], 1)


class Lattice:
    """All pieces that occur in some words, with their places. ``edges`` are
    ordered by their end: word, begin, end, piece."""

    def __init__(self, words: list[bytes], vocabulary: str = VOCABULARY):
        find = pieces(vocabulary).get
        texts, self.owner = [], []
        self.long: list[tuple[int, LongWord]] = []
        for k, w in enumerate(words):
            t = "▁" + w.decode("utf-8", "replace")
            if len(t) > LONGEST_WORD:
                self.long.append((k, LongWord(t, vocabulary)))
            else:
                texts.append(t)
                self.owner.append(k)
        out: list[int] = []
        add = out.append
        for k, t in enumerate(texts):
            n = len(t)
            for a in range(n):
                place = (k << 10 | a << 5) << 16  # text, begin, end and piece in one number
                found = find(t[a])
                add(place + (a + 1 << 16) + (found if found and found > 0 else 0))
                if found is None:
                    continue
                for b in range(a + 2, n + 1):
                    found = find(t[a:b])
                    if found is None:
                        break
                    if found > 0:
                        add(place + (b << 16) + found)
        codes = np.array(out, np.int64)
        self.edges = np.stack([codes >> 26, codes >> 21 & 31, codes >> 16 & 31, codes & 0xFFFF], 1)
        self.edges = self.edges[np.argsort(self.edges[:, 2], kind="stable")]
        self.length = np.array([len(t) for t in texts], np.int64)
        self.cuts = np.searchsorted(self.edges[:, 2], np.arange(1, LONGEST_WORD + 2))
        self.owner = np.array(self.owner, np.int64)
        self.n_words = len(words)

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Per text and place, the probability of all that leads there."""
        f = np.zeros((len(self.length), LONGEST_WORD + 1, p.shape[1]))
        f[:, 0] = 1
        for end in range(1, LONGEST_WORD + 1):
            k, a, _, piece = self.edges[self.cuts[end - 1]:self.cuts[end]].T
            if len(k):
                _add(f[:, end], k, f[k, a] * p[piece])
        return f

    def totals(self, f: np.ndarray) -> np.ndarray:
        return f[np.arange(len(self.length)), self.length]

    def log_probabilities(self, p: np.ndarray) -> np.ndarray:
        """Per word and language."""
        out = np.zeros((self.n_words, p.shape[1]))
        if len(self.owner):
            out[self.owner] = np.log(np.maximum(self.totals(self.forward(p)), 1e-300))
        for k, word in self.long:
            out[k] = word.log_probability(p)
        return out

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected numbers of each piece, the words occurring ``counts`` times."""
        f = self.forward(p)
        total = np.maximum(self.totals(f), 1e-300)
        b = np.zeros_like(f)
        b[np.arange(len(self.length)), self.length] = 1
        shares = np.zeros((len(self.edges), p.shape[1]))
        for end in range(LONGEST_WORD, 0, -1):
            edges = slice(self.cuts[end - 1], self.cuts[end])
            k, a, _, piece = self.edges[edges].T
            if len(k):
                flow = p[piece] * b[k, end]
                b[k, a] += flow  # one edge from a place to this end
                shares[edges] = f[k, a] * flow / total[k] * counts[self.owner[k]]
        found = np.stack([np.bincount(self.edges[:, 3], s, len(p)) for s in shares.T], 1)
        return sum((word.expected(p, counts[k]) for k, word in self.long), found)


def _add(target: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """Add rows of values; ``at`` ascends (edges of one end keep their texts' order)."""
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    target[at[first]] += np.add.reduceat(values, first, axis=0)


def smoothed(expected: np.ndarray) -> np.ndarray:
    """Probabilities of expected counts, drawn towards the languages' common ones."""
    common = expected.sum(1, keepdims=True) + FLOOR
    common /= common.sum()
    return (expected + PRIOR * common) / (expected.sum(0, keepdims=True) + PRIOR)


class Model:
    """Languages and the probabilities of pieces in them."""

    def __init__(self, languages: list[str], p: np.ndarray):
        self.languages, self.p = languages, p


def word_counts(rows: DataFrame) -> DataFrame:
    """``word, lang, n`` of ``rows(text, lang)``; counted in the tasks first."""
    def run(batches):
        for b in batches:
            by_lang: dict[str, Counter] = {}
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
                by_lang.setdefault(lang, Counter()).update(words_of(text))
            out = [(w, lang, n) for lang, c in by_lang.items() for w, n in c.items()]
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.string(), pa.int64()), strict=True)],
                                             ["word", "lang", "n"])

    return (rows.select("text", "lang").mapInArrow(run, "word binary, lang string, n long")
            .groupBy("word", "lang").agg(F.sum("n").alias("n")))


def train(rows: DataFrame, training_texts: int = TRAINING_TEXTS, rounds: int = ROUNDS,
          vocabulary: str = VOCABULARY) -> Model | None:
    """Learn of ``rows(text, lang)``; None without any labelled text.

    Of each language about ``training_texts`` distinct texts are taken, chosen
    by hash, and each is learnt from once: copies change nothing."""
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL").select(
        "text", F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("h2"))
    sizes = {r["lang"]: r["n"] for r in rows.select("lang", "h", "h2").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    limit = F.create_map(*[F.lit(x) for lang in languages for x in (lang, int((1 << 20) * min(1.0, training_texts / sizes[lang])) + 1)])
    chosen = (rows.where(F.pmod("h", F.lit(1 << 20)) < limit[F.col("lang")])
              .groupBy("lang", "h", "h2").agg(F.any_value("text").alias("text")))  # copies meet map-side
    spark = rows.sparkSession
    # one row per word, with its count in each language
    columns = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{k}") for k, lang in enumerate(languages)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = stored(word_counts(chosen).groupBy("word").agg(F.array(*columns).alias("counts")).repartition(parts), "language-words")
    size = n_pieces(vocabulary)
    p = np.full((size, len(languages)), 1.0 / size)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(p)

        def expect(batches, shared=shared):
            total = np.zeros(shared.value.shape)
            for b in batches:
                counts = np.array(b.column("counts").to_pylist(), float).reshape(-1, total.shape[1])
                total += Lattice(b.column("word").to_pylist(), vocabulary).expected(shared.value, counts)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(total[piece, lang])],
                                             ["piece", "lang", "n"])

        found = words.mapInArrow(expect, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        table = found.toArrow()  # at most pieces * languages rows
        expected = np.zeros_like(p)
        expected[table["piece"].to_numpy(), table["lang"].to_numpy()] = table["n"].to_numpy()
        p = smoothed(expected)
    return Model(languages, p)


class Scorer:
    """Log-probabilities of words, kept for words met before."""

    def __init__(self, model: Model, vocabulary: str = VOCABULARY):
        self.model, self.vocabulary = model, vocabulary
        self.places: dict[bytes, int] = {}
        self.scores = np.zeros((1 << 12, len(model.languages)))

    def learn(self, lacking: list[bytes]) -> None:
        for a in range(0, len(lacking), 10_000):
            part = lacking[a:a + 10_000]
            at = len(self.places)
            while at + len(part) > len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.scores[at:at + len(part)] = Lattice(part, self.vocabulary).log_probabilities(self.model.p)
            self.places.update(zip(part, range(at, at + len(part)), strict=True))

    def score(self, texts: list[list[bytes]]) -> np.ndarray:
        """Per text (its words) and language."""
        if len(self.places) > CACHE_WORDS:
            self.places.clear()
        words = [w for t in texts for w in t]
        lacking = list(set(words).difference(self.places))
        if lacking:
            self.learn(lacking)
        at = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        ends = np.cumsum([len(t) for t in texts])
        sums = np.concatenate([np.zeros((1, self.scores.shape[1])), np.cumsum(self.scores[at], 0)])
        return np.diff(sums[np.concatenate([[0], ends])], axis=0)


def predict(docs: DataFrame, model: Model | None, keep: list, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` narrowed to ``keep``, ``lang_pred`` and ``score``: the language
    with the highest probability and its share among all."""
    kept = docs.select(*keep, F.col("text").alias("_text"))
    schema = kept.drop("_text").schema.add("lang_pred", "string").add("score", "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import regex

        letter = regex.compile(r"\p{L}")
        scorer = Scorer(shared.value, vocabulary) if shared.value else None
        for b in batches:
            texts = [t if scorer and t and letter.search(t) else None for t in b.column("_text").to_pylist()]
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            known = [k for k, t in enumerate(texts) if t is not None]
            for a in range(0, len(known), 250):
                part = known[a:a + 250]
                for k, logs in zip(part, scorer.score([words_of(texts[k]) for k in part]), strict=True):
                    best = int(np.argmax(logs))
                    names[k] = scorer.model.languages[best]
                    scores[k] = float(1 / np.exp(np.minimum(logs - logs[best], 0)).sum())
            columns = [b.column(k) for k in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             [*b.schema.names[:-1], "lang_pred", "score"])

    return kept.mapInArrow(run, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             folds: int = 4, held_fold: int = 2) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    Rows whose crc32(id as text) leaves ``held_fold`` when divided by ``folds``
    are held out of training, as are null languages; a null id isn't held out.
    A text that is null or has no letter is ``und`` with score 0, as is every
    text if there is nothing to learn from. Equal probabilities go to the first
    language by name. Repeated rows count as often; an empty table gives an
    empty result."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held_fold, F.lit(False))
    model = train(docs.where(~held))
    return predict(docs, model, [F.col("doc_id"), held.alias("held_out")])


def known_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    least_share: float = LEAST_SHARE) -> DataFrame:
    """``docs`` in a known language: what the model predicts, with at least
    ``least_share`` of the probability of all languages; columns as they were. Each
    row is judged by its own text, where it lies."""
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])  # no name clashes with the result's
    own = {name: F.col(f"c{names.index(name)}") for name in (id_col, text_col, lang_col)}
    held = F.coalesce(F.crc32(own[id_col].cast("string")) % 4 == 2, F.lit(False))
    model = train(plain.where(~held).select(own[text_col].alias("text"), own[lang_col].alias("lang")))
    found = predict(plain.withColumn("text", own[text_col]), model, [F.col(f"c{k}") for k in range(len(names))])
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_share)).drop("lang_pred", "score").toDF(*names)
