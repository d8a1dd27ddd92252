"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, maps homoglyphs and accented letters to plain letters,
digits and signs that stand for letters to those, drops invisible characters and
turns all else into spaces.  A sign counts as a letter only before a letter:
"!" ends a word as often as it stands for one.  Lexicon entries are word beginnings with the
logarithm of how much oftener toxic texts use them; a word counts by its
weightiest entry, and not at all inside an exception phrase.  The sum, as a
share of the text's length, and the sum of the heaviest stretch of STRETCH
characters are turned into a probability.

Entries, weights, exceptions and the final curve are learned from a bounded
sample of labelled texts: at most PER_CLASS of each label, of at most
SAMPLE_CHARS characters.  The lexicon has at most ENTRIES entries, the
exception list as many, so what is broadcast is small whatever the corpus.

Defined results: null and empty texts have the score of a text without hits;
labels other than 0 and 1 and null ones are ignored; a doc_id labelled both ways
counts once for each; repeated rows are scored each for itself; without both
labels in the sample every score is 0; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import lean
from granary.llm.langid import bounded_sample, held_out

PER_CLASS = 1500
SAMPLE_CHARS = 20_000
ENTRIES = 2000
LEAST_STEM, MOST_STEM = 4, 12
#: An entry must be in so many toxic texts, and so many times oftener in them.
LEAST_TEXTS, LEAST_LIFT = 3, 8.0
THRESHOLD = 0.7
STRETCH = 1200

#: Look-alike letters, and digits and signs read as letters.
HOMOGLYPHS = dict(zip("абвеікмнорстухѕјԁӏαβεικνορτυχ", "abbeikmhopctyxsjdlabeiknoptux"))
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
#: Signs and digits that no letter follows, at the start of such a run.
_LOOSE = re.compile(r"(?<![@$!0-9])[@$!0-9]++(?![^\W\d_])")
_SIGNS_OUT = str.maketrans("@$!", "   ")
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"


class _Fold(dict):
    """str.translate table, filled as characters appear."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if c in INVISIBLE or unicodedata.combining(c):
            to = ""
        else:
            plain = unicodedata.normalize("NFKD", c)[:1].lower()
            plain = HOMOGLYPHS.get(plain, SIGNS.get(plain, plain))
            to = plain if plain.isalnum() else " "
        self[code] = to
        return to


def fold(text: str, table: dict) -> str:
    text = _LOOSE.sub(lambda m: m[0].translate(_SIGNS_OUT), text.lower())
    return f" {' '.join(text.translate(table).split())} "


class Lexicon:
    """Weights of word beginnings, exception phrases and the final curve."""

    def __init__(self, weights: dict[str, float], exceptions: list[str] = (), curve=(0.0, 1.0, 1.0)) -> None:
        self.weights, self.exceptions, self.curve = weights, list(exceptions), tuple(curve)

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for stem, w in self.weights.items():
            a.add_word(f" {stem}", (len(stem) + 1, w))
        for phrase in self.exceptions:
            a.add_word(f" {phrase} ", (len(phrase) + 2, None))
        a.make_automaton()
        return a

    @staticmethod
    def hits(automaton, folded: str) -> dict[int, float]:
        """Weight by the place of each word that counts."""
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        if len(automaton):
            for end, (n, w) in automaton.iter(folded):
                at = end - n + 1
                if w is None:
                    spared.append((at, end))
                elif w > best.get(at, 0.0):
                    best[at] = w
        if spared and best:
            # Both in order of place: one walk, however many there are.
            spared.sort()
            upto, i, kept = -1, 0, {}
            for at in sorted(best):
                while i < len(spared) and spared[i][0] <= at:
                    upto = max(upto, spared[i][1])
                    i += 1
                if at >= upto:
                    kept[at] = best[at]
            best = kept
        return best

    @staticmethod
    def features(hits: dict[int, float], n_words: int) -> tuple[float, float]:
        """Weight as a share of the text's length, and weight of the heaviest
        STRETCH characters, so neither grows with the length alone."""
        most = held = 0.0
        places, first = sorted(hits), 0
        for at in places:
            held += hits[at]
            while places[first] <= at - STRETCH:
                held -= hits[places[first]]
                first += 1
            most = max(most, held)
        return math.log1p(100 * sum(hits.values()) / (n_words + 20)), math.log1p(most)

    def score(self, automaton, folded: str) -> float:
        x, y = self.features(self.hits(automaton, folded), folded.count(" ") - 1)
        b, u, v = self.curve
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, b + u * x + v * y))))


def _stems(word: str) -> list[str]:
    return [word[:k] for k in range(LEAST_STEM, min(MOST_STEM, len(word)) + 1)] or [word]


def learn(toxic: list[str], clean: list[str]) -> Lexicon:
    """A lexicon of texts with label 1 and texts with label 0."""
    table = _Fold()
    folded = {1: [fold(t, table) for t in toxic], 0: [fold(t, table) for t in clean]}
    if not toxic or not clean:
        return Lexicon({}, [], (-1000.0, 0.0, 0.0))
    uses, texts, size = {}, Counter(), {}
    for label in (1, 0):
        count: Counter = Counter()
        for t in folded[label]:
            here = Counter(s for w, n in Counter(t.split()).items() for s in _stems(w) for _ in range(n))
            count.update(here)
            if label:
                texts.update(here.keys())
        uses[label], size[label] = count, sum(t.count(" ") for t in folded[label]) + 1
    gain = {}
    for s, n in texts.items():
        rate = uses[1][s] / size[1]
        base = (uses[0][s] + 1) / (size[0] + 1)
        if n >= LEAST_TEXTS and rate / base >= LEAST_LIFT:
            gain[s] = (uses[1][s] * math.log(rate / base), math.log(rate / base))
    # A longer entry must be the stronger one to stand beside its beginning.
    chosen: dict[str, float] = {}
    for s in sorted(gain, key=lambda s: (-gain[s][0], s))[:ENTRIES]:
        chosen[s] = gain[s][1]
    chosen = {s: w for s, w in chosen.items() if all(chosen.get(s[:k], -1) < w for k in range(1, len(s)))}
    # Phrases of two words that clean texts use and toxic ones do not.
    plain = Lexicon(chosen)
    automaton, phrases = plain.automaton(), {1: Counter(), 0: Counter()}
    for label in (1, 0):
        for t in folded[label]:
            for at in Lexicon.hits(automaton, t):
                left, right = t[:at].rsplit(" ", 1)[-1], t[at + 1 :].split(" ", 2)
                phrases[label].update({f"{left} {right[0]}".strip(), " ".join(right[:2]).strip()})
    spared = [p for p, n in phrases[0].most_common() if " " in p and n >= 3 and n * size[1] > 4 * phrases[1][p] * size[0]][:ENTRIES]
    lexicon = Lexicon(chosen, spared)
    automaton = lexicon.automaton()
    rows = [(1.0, *Lexicon.features(Lexicon.hits(automaton, t), t.count(" ") - 1), label) for label in (1, 0) for t in folded[label]]
    x, y = np.array([r[:3] for r in rows]), np.array([r[3] for r in rows], float)
    b = np.zeros(3)
    for _ in range(30):  # Newton steps of a lightly penalised logistic fit
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        b += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3), x.T @ (y - p) - 0.1 * b)
    lexicon.curve = tuple(map(float, b))
    return lexicon


def fit(docs: DataFrame, labels: DataFrame, per: int = PER_CLASS) -> Lexicon:
    """Learn from the rows of ``labels`` (doc_id, toxic) that have a text."""
    rows = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic").distinct()
    rows = bounded_sample(rows, "toxic", per, F.col("doc_id")).limit(4 * per)
    texts = docs.where(F.length("text") <= SAMPLE_CHARS).select("doc_id", "text").join(F.broadcast(rows), "doc_id")
    found = texts.select("toxic", "text").limit(8 * per).collect()
    return learn([r.text for r in found if r.toxic == 1], [r.text for r in found if r.toxic == 0])


def scorer(docs: DataFrame, lexicon: Lexicon):
    """A function of a text column that gives its score."""
    shared, table = docs.sparkSession.sparkContext.broadcast(lexicon), _Fold()

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon = shared.value
        automaton = lexicon.automaton()
        for texts in batches:
            yield pd.Series([lexicon.score(automaton, fold(t or "", table)) for t in texts], dtype="float64")

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return lean(scores)(batches)

    return scored


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, held_out, score, predicted for (doc_id, held_out, text)."""
    out = docs.select("doc_id", "held_out", scorer(docs, lexicon)("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def rejected_out(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores under the threshold."""
    return docs.where(scorer(docs, lexicon)("text") < threshold)


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.where(~held_out(F.col("doc_id"), 3, 1))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", held_out(F.col("doc_id"), 3, 1).alias("held_out"))
    return score(docs, fit(docs, training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))))
