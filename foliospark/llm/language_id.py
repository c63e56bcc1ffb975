"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is the sum,
over all ways to cut it into pieces, of the product of their probabilities; the forward algorithm computes it.
The probabilities are learned by expectation maximisation over the same sums.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, crc_mod, hash_share, read_table, release_memory, tidy

VOCABULARY = "piece_bpe_32k.model"
#: About so many labelled texts of each language are learned from.
SAMPLE_PER_LANGUAGE = 400
ROUNDS = 3
#: Added to the expected count of each piece.
SMOOTHING = 0.02
#: Words that a worker remembers at most.
REMEMBERED = 400_000
#: Words whose cuts are summed at a time.
WORDS_AT_ONCE = 5_000
#: Longer words are cut every so many characters, which keeps the products within a double.
LONG_WORD = 40
#: The longest piece, in characters.
LONG_PIECE = 12
#: Probability of a character that no piece has, as a share of a piece seen once.
UNKNOWN = 1e-7
UND = "und"
#: Signs that Python counts as word characters but that are no letters, such as fractions and circled numbers.
_NUMBERS = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal()]
_BLANK = str.maketrans(dict.fromkeys(_NUMBERS, " "))
#: One of them, or any sign beyond the basic plane: a class that is searched fast.
_number = re.compile(f"[{re.escape(''.join(c for c in _NUMBERS if ord(c) < 0x10000))}\U00010000-\U0010ffff]").search
_runs = re.compile(r"[^\W\d_]+").findall


def letters(text: str) -> list[str]:
    """The runs of letters (\\p{L}+) of a text."""
    return _runs(text if text.isascii() or not _number(text) else text.translate(_BLANK))


def load_pieces(path: str) -> list[str]:
    """The vocabulary's pieces in lower case, without control and byte pieces; the word mark is a space."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {}
    for k in range(sp.get_piece_size()):
        if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k)):
            piece = sp.id_to_piece(k).replace("▁", " ").lower()
            if 0 < len(piece) <= LONG_PIECE and " " not in piece[1:] and piece != " ":
                found[piece] = None
    return list(found)


def words_of(text: str | None) -> list[str]:
    """The words whose letters are scored, in lower case, each with its word mark."""
    return [" " + w for w in letters(text.lower())] if text else []


def word_parts(word: str) -> list[str]:
    """The word, or its parts of LONG_WORD characters."""
    return [word[i : i + LONG_WORD] for i in range(0, len(word), LONG_WORD)]


class Lattice:
    """All cuts of words into pieces of a vocabulary; a character that is no piece is one of its own."""

    def __init__(self, pieces: list[str]):
        self.ids = {p: k for k, p in enumerate(pieces)}
        self.unknown = len(pieces)
        self.longest = max(map(len, pieces), default=1)

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """word, start, end and piece of every edge."""
        at, start, end, piece = [], [], [], []
        get, longest = self.ids.get, self.longest
        for k, w in enumerate(words):
            n = len(w)
            for i in range(n):
                one = False
                for j in range(i + 1, min(n, i + longest) + 1):
                    p = get(w[i:j])
                    if p is not None:
                        at.append(k)
                        start.append(i)
                        end.append(j)
                        piece.append(p)
                        one = one or j == i + 1
                if not one:
                    at.append(k)
                    start.append(i)
                    end.append(i + 1)
                    piece.append(self.unknown)
        return tuple(np.array(x, dtype=np.int64) for x in (at, start, end, piece))

    def forward(self, words: list[str], model: np.ndarray, edges=None) -> np.ndarray:
        """alpha[word, position, language]: the sum over all cuts of the word's first characters."""
        at, start, end, piece = edges if edges is not None else self.edges(words)
        longest = max(map(len, words), default=0)
        alpha = np.zeros((len(words), longest + 1, model.shape[1]))
        alpha[:, 0] = 1.0
        order = np.argsort(end, kind="stable")
        cuts = np.searchsorted(end[order], np.arange(1, longest + 2))
        for e in range(1, longest + 1):
            here = order[cuts[e - 1] : cuts[e]]
            terms = alpha[at[here], start[here]] * model[piece[here]]
            for lang in range(model.shape[1]):
                alpha[:, e, lang] = np.bincount(at[here], terms[:, lang], len(words))
        return alpha

    def log_probability(self, words: list[str], model: np.ndarray) -> np.ndarray:
        """Natural logarithm of each word's probability in each language."""
        parts = [word_parts(w) for w in words]
        flat = [p for own in parts for p in own]
        alpha = self.forward(flat, model)
        sizes = np.fromiter(map(len, flat), dtype=np.int64, count=len(flat))
        logs = np.log(np.maximum(alpha[np.arange(len(flat)), sizes], 1e-300))
        owner = np.repeat(np.arange(len(words)), [len(own) for own in parts])
        return np.stack([np.bincount(owner, logs[:, k], len(words)) for k in range(model.shape[1])], axis=1)

    def expected(self, words: list[str], counts: np.ndarray, model: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece, over all cuts weighted by their probability (one language)."""
        edges = at, start, end, piece = self.edges(words)
        alpha = self.forward(words, model, edges)[:, :, 0]
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        beta = np.zeros_like(alpha)
        beta[np.arange(len(words)), sizes] = 1.0
        order = np.argsort(-start, kind="stable")
        longest = alpha.shape[1] - 1
        cuts = np.searchsorted(-start[order], np.arange(-longest, 2))
        for k, s in enumerate(range(longest, -1, -1)):
            here = order[cuts[k] : cuts[k + 1]]
            if len(here):
                beta[:, s] += np.bincount(at[here], beta[at[here], end[here]] * model[piece[here], 0], len(words))
        whole = alpha[np.arange(len(words)), sizes]
        use = counts[at] * alpha[at, start] * model[piece, 0] * beta[at, end] / np.maximum(whole[at], 1e-300)
        return np.bincount(piece, use, self.unknown + 1)


class LanguageModel:
    """Piece probabilities of each language, in the order of languages."""

    def __init__(self, languages: list[str], pieces: list[str], model: np.ndarray):
        self.languages, self.pieces, self.model = languages, pieces, model


def fit_language(lattice: Lattice, words: list[str], counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities by expectation maximisation; the last one is for unknown characters."""
    parts = [word_parts(w) for w in words]
    words, counts = [p for own in parts for p in own], np.repeat(counts, [len(own) for own in parts])
    model = np.full((lattice.unknown + 1, 1), 1.0 / (lattice.unknown + 1))
    for _ in range(rounds):
        total = np.zeros(lattice.unknown + 1)
        for k in range(0, len(words), WORDS_AT_ONCE):
            total += lattice.expected(words[k : k + WORDS_AT_ONCE], counts[k : k + WORDS_AT_ONCE], model)
        total[: lattice.unknown] += SMOOTHING
        total[lattice.unknown] = 0
        model = (total / total.sum())[:, None]
        model[lattice.unknown] = UNKNOWN
        model /= model.sum()
    return model[:, 0]


def labelled_sample(docs: DataFrame, per_language: int) -> DataFrame:
    """lang and text of about per_language labelled texts of each language, chosen by a hash of doc_id."""
    labelled = docs.filter(F.col("lang").isNotNull() & (F.col("lang") != UND))
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("__n"))
    share = F.lit(float(per_language)) / F.col("__n")
    return labelled.join(F.broadcast(sizes), "lang").filter(hash_share("doc_id", "language") < share).select("lang", "text")


def train(docs: DataFrame, path: str, per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Learns from text and lang of docs; all words of the chosen texts count. Without labelled texts the model has no languages."""
    words = labelled_sample(docs, per_language).select(
        "lang", F.explode(F.expr(r"regexp_extract_all(lower(text), '\\p{L}+', 0)")).alias("word")
    )
    by_lang: dict[str, tuple[list[str], list[int]]] = {}
    for lang, word, n in words.groupBy("lang", "word").count().orderBy("lang", "word").toLocalIterator():
        own = by_lang.setdefault(lang, ([], []))
        own[0].append(" " + word)
        own[1].append(n)
    pieces = load_pieces(path)
    lattice = Lattice(pieces)
    languages = sorted(by_lang)
    columns = [fit_language(lattice, by_lang[k][0], np.array(by_lang[k][1], dtype=float)) for k in languages]
    model = np.stack(columns, axis=1) if columns else np.zeros((len(pieces) + 1, 0))
    del by_lang, columns
    release_memory()
    return LanguageModel(languages, pieces, model)


class Scorer:
    """Scores texts with a bounded memory of words."""

    def __init__(self, model: LanguageModel):
        self.model, self.lattice = model, Lattice(model.pieces)
        self.at: dict[str, int] = {}
        self.logs = np.zeros((1024, len(model.languages)))
        self.again = np.zeros(1024, dtype=bool)  # words that a second block had

    def _learn(self, words: set[str]) -> None:
        """Puts the words' logarithms into the table, which grows by doubling; when it is full, only words that came again stay."""
        known = [w for w in words if w in self.at]
        self.again[[self.at[w] for w in known]] = True
        if len(self.at) + len(words) - len(known) > REMEMBERED:
            self._forget()
        new = [w for w in words if w not in self.at]
        base = len(self.at)
        while base + len(new) > len(self.logs):
            self.logs = np.concatenate((self.logs, np.zeros_like(self.logs)))
            self.again = np.concatenate((self.again, np.zeros_like(self.again)))
        for k in range(0, len(new), WORDS_AT_ONCE):
            some = new[k : k + WORDS_AT_ONCE]
            self.logs[base + k : base + k + len(some)] = self.lattice.log_probability(some, self.model.model)
        self.again[base : base + len(new)] = False
        self.at.update((w, base + k) for k, w in enumerate(new))

    def _forget(self) -> None:
        stay = np.flatnonzero(self.again[: len(self.at)])
        if 2 * len(stay) > REMEMBERED:
            stay = stay[:0]
        kept = set(stay.tolist())
        words = [w for w, k in self.at.items() if k in kept]  # in order of their rows
        self.at = {w: k for k, w in enumerate(words)}
        self.logs[: len(stay)] = self.logs[stay]
        self.again[: len(stay)] = False

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The likeliest language and its posterior probability; `und` with 0 where there are no letters."""
        names, scores = [UND] * len(texts), [0.0] * len(texts)
        split = [words_of(t) for t in texts]
        if not self.model.languages:
            return names, scores
        self._learn(set().union(*split))
        get = self.at.__getitem__
        for k, own in enumerate(split):
            if own:
                rows = np.fromiter(map(get, own), dtype=np.int64, count=len(own))
                total = self.logs[rows].sum(axis=0)
                best = int(np.argmax(total))
                names[k] = self.model.languages[best]
                scores[k] = float(1.0 / np.exp(np.maximum(total - total[best], -700)).sum())
        return names, scores


def language_of(model: LanguageModel, spark: SparkSession) -> Callable[[Column], Column]:
    """A function from a text column to a struct of lang_pred and score.

    lang_pred is `und` and score 0 for a null text and one without letters. Languages with equal sums: the first
    by name. The model, as large as the vocabulary times the learned languages, is broadcast.
    """
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @tidy
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for texts in batches:
            names, scores = [], []
            for block in _blocks(texts):
                found = scorer.predict([t if isinstance(t, str) else None for t in block])
                names += found[0]
                scores += found[1]
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return F.pandas_udf(run, "lang_pred string, score double")


def _blocks(texts: pd.Series, chars: int = 2_000_000) -> Iterator[pd.Series]:
    """The series in parts of about so many characters, which bounds what one prediction holds."""
    sizes = texts.str.len().fillna(0).to_numpy() if len(texts) else []
    start, held = 0, 0
    for stop in range(1, len(texts) + 1):
        held += sizes[stop - 1]
        if held >= chars or stop == len(texts):
            yield texts.iloc[start:stop]
            start, held = stop, 0


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score of every row of docs, repeated ones too; an empty table gives none.

    Whole texts count, however long. Other columns of docs, whatever their names, are not read.
    """
    found = language_of(model, docs.sparkSession)(F.col("text"))
    return docs.select("doc_id", found.alias("__found")).select("doc_id", "__found.*")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs.filter(crc_mod("doc_id", 5) != 0), public_tokenizers.path(VOCABULARY))
    return predict_language(docs, model).select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = 0.0) -> DataFrame:
    """The rows of docs whose language was told, with a probability of at least `least` if that is given, with docs' columns."""
    found = language_of(model, docs.sparkSession)(F.col("text"))
    told = docs.select(F.struct("*").alias("__row"), found.alias("__found"))
    return told.filter((F.col("__found.lang_pred") != UND) & (F.col("__found.score") >= least)).select("__row.*")


QUERIES = {"op1_language_id": op1_language_id}
ORACLES: dict[str, str] = {}
