"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text.

Texts are folded first: compatibility forms, look-alike letters of other scripts and digits or
signs put for letters become plain lower-case letters. Lexicon entries are words and beginnings of
words; what a harmless phrase covers, of a fixed list or learned, does not count. The summed weights are
normalised by length, and a logistic curve turns them into a score. Entries, weights and curve are
learned from labelled rows.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import prepare, text_or_empty, written

# At most so many labelled rows are learned from: those whose ids have the smallest hashes.
TRAIN_ROWS = 20_000
LEXICON_ENTRIES = 20_000
PREFIXES = (3, 4, 5, 6, 7)
# An entry is taken when fewer entries than this would look as toxic by chance, of all that were seen.
FALSE_ENTRIES = 1.0
LEAST_TOXIC = 3
# Look-alikes (capital and small Cyrillic and Greek) and the Latin letters they stand for.
LOOKALIKES = dict(zip("аеорсухіјѕԁһԛԝкмтвнАВЕКМНОРСТУХІЈЅαβεικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                      "aeopcyxijsdhqwkmtbhabekmhopctyxijsabeiknoptuxabezhikmnoptyx", strict=True))
# Digits and signs put for letters.
SUBSTITUTES = dict(zip("013457@$!|", "oieastasii", strict=True))
# A phrase is learned as harmless when at least so many rows hold it and at most this share of them, and of all
# rows, is toxic; so many phrases at most.
LEAST_CLEAN = 5
MOST_TOXIC_SHARE = 0.1
LEARNED_PHRASES = 2_000
# Harmless phrases that hold words of an English lexicon; others are learned.
EXCEPTIONS = ("trash can", "trash bin", "recycle trash", "clown fish", "clown car", "sore loser rule",
              "pond scum", "soap scum", "moron city", "pathetic fallacy")
_SUBSTITUTE = str.maketrans(SUBSTITUTES)
_LOOKALIKE = str.maketrans(LOOKALIKES)
_OTHER = re.compile(r"[\W\d_]+")
_MIXED = re.compile(r"\S*[013457@$!|]\S*")
_END = "!|.,;:?\"')]}%*&$@#-"


def _spelled(match: re.Match) -> str:
    """A word with digits or signs among its letters, spelled with letters; marks behind it stay."""
    token = match.group()
    core = token.rstrip(_END)
    if any(c.isalpha() for c in core):
        return core.translate(_SUBSTITUTE) + token[len(core):]
    return token


def fold(text: str) -> str:
    """Folded words between single spaces, with one at either end."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
        words = text.split()
        # Look-alikes are folded in words that also hold Latin letters; Cyrillic or Greek text stays.
        for i, w in enumerate(words):
            if not w.isascii() and any(c in LOOKALIKES for c in w) and re.search("[a-zA-Z]", w):
                words[i] = w.translate(_LOOKALIKE)
        text = " ".join(words)
    text = _MIXED.sub(_spelled, text)
    return f" {_OTHER.sub(' ', text.lower()).strip()} "


def terms(folded: str) -> set[str]:
    """Possible entries of a folded text: ` word ` and ` begin`."""
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in PREFIXES if len(w) >= n)
    return out


@dataclass
class Lexicon:
    """Entries with their weights, the phrases that excuse them, and the curve."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, ...] = (-4.0, 2.0, 1.0)
    _automaton: object = field(default=None, repr=False)

    def automaton(self):
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                self._automaton.add_word(entry, (len(entry), weight))
            for phrase in self.exceptions:
                self._automaton.add_word(fold(phrase), (len(fold(phrase)), None))
            if len(self._automaton):
                self._automaton.make_automaton()
        return self._automaton

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "curve": self.curve,
                "_automaton": None}

    def features(self, text: str) -> tuple[float, float]:
        """(logarithm of the summed weights, logarithm of the sum per hundred words)."""
        automaton = self.automaton()
        if not len(automaton):
            return 0.0, 0.0
        folded = fold(text)
        best: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        for end, (size, weight) in automaton.iter(folded):
            start = end - size + 1
            if weight is None:
                excused.append((start, end))
            elif weight > best.get(start, 0.0):  # one hit per word, the weightiest entry
                best[start] = weight
        total = sum(best[s] for s in _outside(sorted(best), sorted(excused)))
        return float(np.log1p(total)), float(np.log1p(100 * total / (folded.count(" ") or 1)))

    def phrases(self, text: str) -> set[str]:
        """The word pairs of a text in which a hit begins."""
        automaton, folded = self.automaton(), fold(text)
        if not len(automaton):
            return set()
        hits = {end - size + 1 for end, (size, weight) in automaton.iter(folded) if weight is not None}
        words, at, out = folded.split(), 0, set()
        for i, word in enumerate(words):
            if at in hits:  # the place of the space before the word
                out.update(" ".join(words[j:j + 2]) for j in (i - 1, i) if 0 <= j < len(words) - 1)
            at += len(word) + 1
        return out

    def score(self, text: str) -> float:
        a, b = self.features(text)
        c = self.curve
        return float(1 / (1 + np.exp(-np.clip(c[0] + c[1] * a + c[2] * b, -30, 30))))


def _outside(starts: list[int], spans: list[tuple[int, int]]):
    """The sorted `starts` that no span (start, end exclusive), sorted by its start, covers; one pass over both."""
    at, end = 0, -1
    for start in starts:
        while at < len(spans) and spans[at][0] <= start:
            end = max(end, spans[at][1])
            at += 1
        if start >= end:
            yield start


def held_out(doc_id) -> F.col:
    """Rows never learned from: CRC-32 of the id as text is divisible by 5; a null id is none."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """(t, toxic): texts to learn from, `most` at most. An id's contradicting labels count as toxic."""
    chosen = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")) \
        .filter("id is not null and toxic in (0, 1)").filter(~held_out(F.col("id"))) \
        .groupBy("id").agg(F.max("toxic").alias("toxic")) \
        .orderBy(F.xxhash64("id"), "id").limit(most)
    # At most `most` rows of two numbers: small enough to be sent to every task.
    return docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("t")) \
        .join(F.broadcast(written(chosen, "training-ids")), "id").select("t", "toxic")


def _term_counts(rows: DataFrame) -> DataFrame:
    def run(batches):
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for term in terms(fold(text)):
                    seen = counts.setdefault(term, [0, 0])
                    seen[0] += toxic
                    seen[1] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string())]
            + [pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1)],
            ["term", "toxic", "rows"])

    return rows.mapInArrow(run, "term string, toxic bigint, rows bigint").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("rows").alias("rows"))


def learn(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Lexicon:
    """A lexicon from the labelled rows that are not held out. Without toxic or without clean rows
    it is empty, and every text scores the share of toxic rows (0 without any)."""
    prepare(docs.sparkSession)
    rows = written(training_rows(docs, labels, most), "training-rows")
    n, n_toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < n_toxic < n:
        rate = n_toxic / n if n else 0.0
        return Lexicon({}, curve=(30.0 if rate == 1 else -30.0, 0.0, 0.0))
    counts = written(_term_counts(rows), "term-counts")
    n_terms = counts.filter(f"rows >= {LEAST_TOXIC}").count()
    base = n_toxic / n
    # The chance that rows picked at random are toxic as often, bounded by the relative entropy.
    p = F.col("toxic") / F.col("rows")
    clean = F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - base))).otherwise(0.0)
    log_chance = -F.col("rows") * (p * F.log(p / base) + clean)
    weight = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log(
        (F.col("rows") - F.col("toxic") + 0.5) / (n - n_toxic + 1))
    limit = float(np.log(FALSE_ENTRIES / max(1, n_terms)))
    chosen = counts.filter(F.col("toxic") >= LEAST_TOXIC).filter(p > max(0.5, base)) \
        .withColumn("log_chance", log_chance).filter(F.col("log_chance") < limit) \
        .select("term", weight.alias("weight")).orderBy(F.desc("weight"), "term").limit(LEXICON_ENTRIES)
    lexicon = Lexicon({r["term"]: float(r["weight"]) for r in chosen.collect()})
    phrases = _phrase_counts(rows, lexicon).filter(
        (F.col("rows") >= LEAST_CLEAN) & (F.col("toxic") <= F.col("rows") * F.lit(min(base, MOST_TOXIC_SHARE))))
    learned = [r["phrase"] for r in phrases.orderBy(F.desc("rows"), "phrase").limit(LEARNED_PHRASES).collect()]
    lexicon = Lexicon(lexicon.weights, EXCEPTIONS + tuple(learned))
    return Lexicon(lexicon.weights, lexicon.exceptions, _curve(rows, lexicon))


def _phrase_counts(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(phrase, toxic, rows): in how many rows a word with a hit stands before or behind the same other word, and how
    many of these are toxic."""
    def run(batches):
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for phrase in lexicon.phrases(text):
                    seen = counts.setdefault(phrase, [0, 0])
                    seen[0] += toxic
                    seen[1] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string())]
            + [pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1)], ["phrase", "toxic", "rows"])

    return rows.mapInArrow(run, "phrase string, toxic bigint, rows bigint").groupBy("phrase").agg(
        F.sum("toxic").alias("toxic"), F.sum("rows").alias("rows"))


def _curve(rows: DataFrame, lexicon: Lexicon) -> tuple[float, ...]:
    """Logistic regression on the two features of the training rows, by Newton steps."""
    def run(batches):
        for batch in batches:
            f = [lexicon.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in f], pa.float64()) for i in (0, 1)] + [batch.column(1)],
                ["a", "b", "toxic"])

    data = rows.mapInArrow(run, "a double, b double, toxic int").toPandas().sort_values(["toxic", "a", "b"])
    x = np.column_stack([np.ones(len(data)), data["a"], data["b"]])
    y = data["toxic"].to_numpy(float)
    ridge = np.diag([1e-3, 1.0, 1.0])
    w = np.zeros(3)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (q * (1 - q) + 1e-9)) @ x + ridge, x.T @ (y - q) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def score_toxicity(docs: DataFrame, labels: DataFrame, lexicon: Lexicon | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on).

    The score depends on the text alone: `labels` (doc_id, toxic) serve only to learn the lexicon, from
    rows that are not held out, unless a lexicon is given. Whole texts are scored; a null or empty
    text gets the score of one without hits. Null ids are scored but never learned from; repeated
    rows are scored alike. An empty table gives no rows; other columns are ignored.
    """
    prepare(docs.sparkSession)
    lexicon = lexicon or learn(docs, labels)

    def run(batches):
        for batch in batches:
            scores = [lexicon.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t")) \
        .mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are not predicted to be toxic, with all their columns.

    A null text counts as empty; rows with null ids, repeated rows and extra columns are kept or dropped by
    their text alone; ids that repeat in `labels` count as toxic if one of their rows is. An empty table gives
    no rows, and without labels every row stays.
    """
    lexicon = learn(docs, labels)

    @F.pandas_udf("boolean")
    def toxic(texts):
        return texts.map(lambda t: lexicon.score(t) >= 0.5).astype(bool)

    return docs.filter(~toxic(text_or_empty()))
