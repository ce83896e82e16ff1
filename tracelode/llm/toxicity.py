"""Toxicity scores by a counterfactual-regularised classifier.

A logistic model over the distinct words of a text and their beginnings is fitted to a bounded
sample of labelled rows. Sentences that name a group are swapped: each identity term becomes each
other one of its kind, and a word for any person, and the fit penalises the change of score between the
two. Swapped are the labelled rows' own sentences and, so that no name goes unseen, generated ones of
every term in neutral frames; a name that the labels say nothing of would otherwise be scored by
the words that begin like it. A group's name thereby carries next to no weight of its own, however often
it stands in toxic sentences.

Fitting takes the sampled rows' distinct words to the driver; rows are bounded, one for each id and
label, words of a row are not. Scoring is one Arrow function over whole texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.llm.common import map_arrow

#: Labelled rows that the fit takes at most: toxic ones and others, least hash of the id first.
MAX_TOXIC, MAX_OTHER = 2000, 4000
#: Lengths of the word beginnings that are features beside the whole word.
PREFIXES = (3, 4, 5, 6)
#: Features are all words and beginnings whose log odds between the labels are so many standard errors
#: off. Some of them are so by chance; those get little weight, while a higher value loses the rare words of small samples.
LEAST_Z = 2.5
#: Weight of the counterfactual penalty: of the mean squared change of the log odds over all swaps.
FAIRNESS = 10.0

WORD = re.compile(r"[^\W\d_]+")

# Terms that name a group, by kind; a term is swapped within its kind.
IDENTITY = {
    "faith": ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    "faith, plural": ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    "gender": ("woman", "man", "girl", "boy", "female", "male", "transgender"),
    "gender, plural": ("women", "men", "girls", "boys", "females", "males"),
    "orientation": ("gay", "straight", "lesbian", "bisexual", "queer", "heterosexual", "homosexual"),
    "origin": ("black", "white", "asian", "latino", "arab", "african", "european", "indigenous"),
    "origin, plural": ("blacks", "whites", "asians", "latinos", "arabs", "africans", "europeans", "immigrants", "refugees"),
    "body": ("disabled", "deaf", "blind", "autistic", "elderly"),
    "frau, mann": ("frau", "mann", "frauen", "männer"),
    "glaube": ("christen", "muslime", "juden", "hindus", "buddhisten"),
    "femme, homme": ("femme", "homme", "femmes", "hommes"),
    "croyance": ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes"),
    "mujer, hombre": ("mujer", "hombre", "mujeres", "hombres"),
    "creencia": ("cristianos", "musulmanes", "judíos", "hindúes", "budistas"),
}

# A word for any person, which terms are swapped for too, and neutral frames around a term.
ANYONE = {
    "faith": "person", "faith, plural": "people", "gender": "person", "gender, plural": "people", "orientation": "person",
    "origin": "person", "origin, plural": "people", "body": "person", "frau, mann": "mensch", "glaube": "menschen",
    "femme, homme": "personne", "croyance": "gens", "mujer, hombre": "persona", "creencia": "gente",
}
FRAMES = (
    "my neighbour is {}", "we met many {} here", "she said that {} is what they are", "der nachbar ist {}", "wir kennen {}",
    "mon voisin est {}", "nous connaissons des {}", "mi vecino es {}", "conocemos a {}",
)

#: term -> what it is swapped for: the others of its kinds, and the words for any person
SWAPS: dict[str, tuple[str, ...]] = {}
for _kind, _terms in IDENTITY.items():
    for _term in _terms:
        SWAPS[_term] = tuple(dict.fromkeys([*SWAPS.get(_term, ()), *(t for t in _terms if t != _term), ANYONE[_kind]]))


def distinct_words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def features(word: str) -> list[str]:
    """The whole word, and its beginnings where it is longer."""
    return [word, *("^" + word[:n] for n in PREFIXES if len(word) > n)]


@dataclass
class Model:
    """Weights by feature, and the bias; a text's score is that of its distinct words' features."""

    weights: dict[str, float]
    bias: float

    def word(self, word: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(word))

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + sum(map(self.word, distinct_words(text)))))))


def training_rows(docs: DataFrame, labels: DataFrame, *, usable: Column, most: tuple[int, int]) -> DataFrame:
    """(doc_id, toxic, text): the sample, at most most[0] toxic rows and most[1] others; of the texts
    that an id has the one with the least hash."""
    clean = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & usable).select("doc_id", "toxic").distinct()
    order = F.xxhash64("doc_id")
    some = clean.where("toxic = 1").orderBy(order, "doc_id").limit(most[0]).unionByName(
        clean.where("toxic = 0").orderBy(order, "doc_id").limit(most[1])
    )
    # `some` has at most sum(most) narrow rows, so it is sent to the texts and not the texts to it.
    met = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    text = F.coalesce("text", F.lit(""))
    return met.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64(text), text.alias("text"))).alias("first")).select(
        "doc_id", "toxic", "first.text"
    )


SENTENCE = re.compile(r"[.!?\n]+")


def named_groups(text: str | None) -> list[str]:
    """Per sentence of a text that names a group: its identity terms, sorted and joined by a blank."""
    low = (text or "").lower()
    return [" ".join(sorted(found)) for part in SENTENCE.split(low) if (found := SWAPS.keys() & set(WORD.findall(part)))]


def word_lists(rows: DataFrame) -> DataFrame:
    """(toxic, words, named): distinct words of each row, and named_groups() of its sentences, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [sorted(distinct_words(x.as_py())) for x in batch.column(1)]
            named = [sorted(set(named_groups(x.as_py()))) for x in batch.column(1)]
            kind = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, kind), pa.array(named, kind)], names=["toxic", "words", "named"]
            )

    kinds = "toxic int, words array<string>, named array<string>"
    return map_arrow(rows.select(F.col("toxic").cast("int").alias("toxic"), "text"), run, kinds)


class Features:
    """Numbers of the features of words."""

    def __init__(self):
        self.names: list[str] = []
        self.number: dict[str, int] = {}
        self.of_word: dict[str, np.ndarray] = {}

    def word(self, word: str) -> np.ndarray:
        found = self.of_word.get(word)
        if found is None:
            ids = []
            for f in features(word):
                if f not in self.number:
                    self.number[f] = len(self.names)
                    self.names.append(f)
                ids.append(self.number[f])
            found = self.of_word[word] = np.array(ids, np.int32)
        return found

    def words(self, words: list[str]) -> np.ndarray:
        return np.concatenate([self.word(w) for w in words]) if words else np.zeros(0, np.int32)


def _uneven(coded: list[np.ndarray], y: np.ndarray, n_features: int, least_z: float) -> np.ndarray:
    """Numbers of the features whose log odds between the labels stand out."""
    n = np.zeros((n_features, 2))
    for ids, label in zip(coded, y.tolist(), strict=True):
        n[np.unique(ids), label] += 1
    often = np.flatnonzero(n.sum(1) >= 3)
    n = n[often] + 0.5
    rest = np.array([(y == 0).sum(), (y == 1).sum()]) + 1 - n
    z = (np.log(n[:, 1] / rest[:, 1]) - np.log(n[:, 0] / rest[:, 0])) / np.sqrt((1 / n + 1 / rest).sum(1))
    return often[np.abs(z) >= least_z]


def _matrix(coded: list[np.ndarray], chosen: np.ndarray, n_features: int) -> np.ndarray:
    """How often each row of `coded` has each of the chosen features."""
    column = np.full(n_features, -1, np.int32)
    column[chosen] = np.arange(len(chosen))
    out = np.zeros((len(coded), len(chosen)), np.float32)
    for i, ids in enumerate(coded):
        cols = column[ids]
        out[i] = np.bincount(cols[cols >= 0], minlength=len(chosen))
    return out


def swaps(sentences: Iterable[str]) -> dict[tuple[str, str, bool], int]:
    """(term, other, whether the sentence has the other already) -> number of such swaps in `sentences`,
    given by their identity terms. In a model of distinct words nothing else of a sentence matters."""
    out: dict[tuple[str, str, bool], int] = {}
    for sentence in sentences:
        terms = sentence.split(" ")
        for term in terms:
            for other in SWAPS[term]:
                key = (term, other, other in terms)
                out[key] = out.get(key, 0) + 1
    return out


def generated() -> list[str]:
    """Sentences of every term in every frame."""
    return [x for frame in FRAMES for term in SWAPS for x in named_groups(frame.format(term))]


def gaps(model: Model) -> list[float]:
    """Changes of score over all swaps in the generated sentences, each without its sign."""
    out = []
    for frame in FRAMES:
        for term, others in SWAPS.items():
            own = model.score(frame.format(term))
            out += [abs(own - model.score(frame.format(other))) for other in others]
    return out


def fit_lists(
    lists: list[list[str]],
    y: np.ndarray,
    sentences: Iterable[str] = (),
    *,
    fairness: float = FAIRNESS,
    lasso: float = 1e-4,
    rounds: int = 300,
    least_z: float = LEAST_Z,
) -> Model:
    """Accelerated proximal gradient on log loss + lasso + fairness * mean squared change under swaps; the
    swaps of the labelled `sentences` and those of the generated ones have half the weight each.

    Without labels of both kinds the model is the smoothed share of toxic rows.
    """
    y = np.asarray(y, np.int64)
    if len(y) == 0 or y.min() == y.max():
        share = (float(y.sum()) + 1) / (len(y) + 2)
        return Model({}, math.log(share / (1 - share)))
    known = Features()
    coded = [known.words(words) for words in lists]
    chosen = _uneven(coded, y, len(known.names), least_z)
    names = [known.names[i] for i in chosen]
    x = _matrix(coded, chosen, len(known.names))
    del coded
    counts = [c for c in (swaps(sentences), swaps(generated())) if c]
    mass = {k: sum(c.get(k, 0) / sum(c.values()) for c in counts) / len(counts) for k in {k for c in counts for k in c}}
    index = {f: j for j, f in enumerate(names)}
    change = np.zeros((len(mass), len(names)), np.float32)
    for i, (term, other, there) in enumerate(mass):
        for word, sign in ((term, 1), *(() if there else ((other, -1),))):
            for f in features(word):
                if (j := index.get(f)) is not None:
                    change[i, j] += sign
    some = np.abs(change).sum(1) > 0
    heavy = np.array(list(mass.values()), np.float32)[some]
    change = change[some]
    scale = np.sqrt((x**2).mean(0)) + 1e-6
    x /= scale
    change /= scale
    # Each label has half the weight of the loss, so that scores do not follow the sample's shares.
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()).astype(np.float32)
    target = y.astype(np.float32)

    def power(m: np.ndarray, w: np.ndarray) -> float:
        v = np.ones(m.shape[1], np.float32)
        norm = 0.0
        for _ in range(15):
            v = m.T @ (w * (m @ v))
            norm = float(np.linalg.norm(v))
            v /= norm or 1.0
        return norm

    step = 1 / (0.25 * (power(x, weight) + 1) + 2 * fairness * power(change, heavy))
    w = np.zeros(len(names), np.float32)
    bias = 0.0
    ahead, ahead_bias, t = w.copy(), bias, 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead + ahead_bias, -30, 30)))
        error = weight * (p - target)
        slope = x.T @ error + 2 * fairness * (change.T @ (heavy * (change @ ahead)))
        new = ahead - step * slope
        new = np.sign(new) * np.maximum(np.abs(new) - step * lasso, 0)
        new_bias = ahead_bias - step * float(error.sum())
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        ahead_bias = new_bias + (t - 1) / t_new * (new_bias - bias)
        w, bias, t = new.astype(np.float32), new_bias, t_new
    gain, offset = _calibration(x @ w + np.float32(bias), y)
    return Model({f: float(gain * v / s) for f, v, s in zip(names, w, scale, strict=True) if v}, float(gain * bias + offset))


def _calibration(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and offset of the margins by smoothed-target logistic regression (Newton steps), each
    label with half the weight."""
    n, m = int((y == 1).sum()), int((y == 0).sum())
    goal = np.where(y == 1, (n + 1) / (n + 2), 1 / (m + 2))
    weight = np.where(y == 1, 0.5 / n, 0.5 / m)
    z = np.stack([margin.astype(np.float64), np.ones(len(y))])
    at = np.array([1.0, 0.0])

    def loss(v: np.ndarray) -> float:
        s = v @ z
        return float((weight * (np.logaddexp(0, s) - goal * s)).sum())

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ z, -30, 30)))
        slope = z @ (weight * (p - goal))
        bend = (z * (weight * p * (1 - p))) @ z.T + 1e-6 * np.eye(2)
        move, size = np.linalg.solve(bend, slope), 1.0
        while size > 1e-4 and loss(at - size * move) > loss(at):
            size /= 2
        if size <= 1e-4 or np.abs(size * move).max() < 1e-6:
            break
        at = at - size * move
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    usable: Column | None = None,
    most: tuple[int, int] = (MAX_TOXIC, MAX_OTHER),
    **options,
) -> Model:
    """Fits on labelled rows of `labels` (doc_id, toxic) that meet `usable` and have a row in `docs`. An id
    labelled both ways is a row of each label; null ids and labels other than 0 and 1 take no part."""
    sample = word_lists(training_rows(docs, labels, usable=F.lit(True) if usable is None else usable, most=most)).toArrow()
    held = sample.column("words").combine_chunks()
    coded = held.flatten().dictionary_encode()
    # Each distinct word is one Python object, however many rows have it.
    names, places = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(held.value_lengths().to_numpy(zero_copy_only=False))]).astype(int)
    lists = [[names[i] for i in places[a:b]] for a, b in zip(ends, ends[1:], strict=False)]
    rows = sorted(zip(sample.column("toxic").to_pylist(), lists, strict=True))
    named = [x for row in sample.column("named").to_pylist() for x in row]
    return fit_lists([w for _, w in rows], np.array([y for y, _ in rows], np.int64), named, **options)


class Scorer:
    """Scores of whole texts, with a bounded cache of words."""

    def __init__(self, model: Model, most: int = 200_000):
        self.model, self.most, self.known = model, most, {}

    def __call__(self, text: str | None) -> float:
        if len(self.known) > self.most:
            self.known = {}
        known, total = self.known, self.model.bias
        for word in distinct_words(text):
            value = known.get(word)
            if value is None:
                value = known[word] = self.model.word(word)
            total += value
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def scores(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score), one row per row of `docs`, from whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            found = [scorer(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(narrow, run, f"doc_id {kind}, score double")


def held_out(id_col: Column) -> Column:
    """Rows that are never learnt from: crc32(id as text) mod 3 is 1; null ids count as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 3 == 1


def toxicity(
    docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score (0 to 1), predicted (score >= threshold).

    Only labels of rows outside held_out() are learnt, an id labelled both ways as a row of each. Null text counts as empty and gets the model's
    bias; null ids stay and are never learnt; repeated rows each give a row; an empty table gives an
    empty one; without labels every score is 0.5.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    model = fit(named, labels, usable=~held_out(F.col("doc_id")), **options)
    return scores(named, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def clean_documents(
    docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """`docs` without the rows whose score reaches `threshold`; one pass over the texts, all columns kept, whatever they
    are called. Null and empty texts get the model's bias; null ids stay and are never learnt; repeated rows are each judged;
    an empty table gives an empty one; without labels all rows stay, as 0.5 is below the usual threshold."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    model = fit(named, labels, usable=~held_out(F.col("doc_id")), **options)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            yield batch.filter(pa.array([scorer(x.as_py()) < threshold for x in batch.column(at)], pa.bool_()))

    # Numbers for names on the way, as names may hold dots.
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return map_arrow(numbered, run, numbered.schema).toDF(*docs.columns)
