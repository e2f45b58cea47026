"""Toxicity: a logistic model whose scores may not move when identity terms are swapped."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField

from .arrow import WORD, Memo, Scratch, WordTable, labelled_sample, map_texts, pieces

#: Terms for groups of people, by language; a term is swapped for others of its list.
IDENTITY = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("immigrants", "natives", "refugees", "citizens"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
    ("disabled", "blind", "deaf", "autistic"),
    ("americans", "mexicans", "africans", "europeans", "chinese", "russians"),
    ("elderly", "teenagers", "children", "adults"),
    ("ausländer", "einheimische", "flüchtlinge", "bürger"),
    ("schwule", "lesben", "schwarze", "weiße"),
    ("behinderte", "blinde", "rentner", "jugendliche"),
    ("étrangers", "immigrés", "réfugiés", "citoyens"),
    ("homosexuels", "lesbiennes", "noirs", "blancs"),
    ("handicapés", "aveugles", "retraités", "jeunes"),
    ("extranjeros", "inmigrantes", "refugiados", "ciudadanos"),
    ("homosexuales", "lesbianas", "negros", "blancos"),
    ("discapacitados", "ciegos", "ancianos", "jóvenes"),
)
#: Sentences of a text without identity terms that get one in turn.
PLANTED = 4
_OTHERS = {t: [o for o in group if o != t] for group in IDENTITY for t in group}
_TRIM = re.compile(r"^[\W_]+|[\W_]+$")
_SENTENCE = re.compile(r"(?<=[.!?\n])")
PREFIXES = (4, 5, 6)
WIDTH = 1 + len(PREFIXES)


def _hash(kind: str, x: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}{x}".encode("utf-8", "surrogatepass")) >> 1


def features(word: str) -> tuple[int, ...]:
    """Hashes of the word in lower case without signs at its ends, and of its beginnings (0 where it is no longer than they are)."""
    w = (word if word.isalnum() else _TRIM.sub("", word)).lower()
    return (_hash("w", w) if w else 0, *(_hash(str(n), w[:n]) if len(w) > n else 0 for n in PREFIXES))


#: One feature for each power of two that the number of a text's distinct words reaches: long texts hold more of any words.
LENGTHS = tuple(_hash("reaches", str(k)) for k in range(32))


def distinct_words(text: str) -> set[str]:
    """A text's distinct words, gathered by pieces."""
    found: set[str] = set()
    for piece in pieces(text):
        found.update(WORD.findall(piece))
    return found


def lengths(n: int) -> tuple[int, ...]:
    """The features of a text with n distinct words."""
    return LENGTHS[: n.bit_length()]


def swaps(sentence: str) -> list[str]:
    """The sentence with its identity terms replaced: the k-th copy takes the k-th other term of each list."""
    words = sentence.split()
    where = {i: _OTHERS[w] for i, x in enumerate(words) if (w := _TRIM.sub("", x).lower()) in _OTHERS}
    most = max(map(len, where.values()), default=0)
    return [" ".join(where[i][k % len(where[i])] if i in where else x for i, x in enumerate(words)) for k in range(most)]


def planted(sentence: str) -> list[str]:
    """The sentence with a word, which its hash picks, replaced by each term of a list, which its hash picks too; none of under three words."""
    words, h = sentence.split(), _hash("slot", sentence)
    if len(words) < 3:
        return []
    place = (h >> 8) % len(words)
    return [" ".join([*words[:place], term, *words[place + 1 :]]) for term in IDENTITY[h % len(IDENTITY)]]


def counterfactuals(text: str | None, known: re.Pattern) -> list[tuple[str, str]]:
    """Pairs of sentences that differ in their identity terms only: those of a text with such terms and their swaps, else PLANTED of its
    sentences, evenly spaced, with a term put in and others in its place. Both mention groups neutrally as far as the label goes."""
    sentences = _SENTENCE.split(text) if text else []
    if text and known.search(text):
        return [(x, other) for x in sentences if known.search(x) for other in swaps(x)]
    long_ = [x for x in sentences if len(x.split(None, 3)) >= 3]
    made = [planted(x) for x in long_[:: max(1, len(long_) // PLANTED)][:PLANTED]]
    return [(first, other) for first, *others in made for other in others]


def planted_term(text: str) -> str:
    """The term that a text without identity terms is seen with a second time in training, picked by its hash."""
    terms = list(_OTHERS)
    return terms[_hash("term", text) % len(terms)]


def _distinct(table: WordTable, text: str, more: bool = False) -> np.ndarray:
    words = list(distinct_words(text))
    found = np.unique(table.of(words))
    return np.concatenate([found[found > 0], np.array(lengths(len(words)) if more else (), np.int64)])


def _sample_features():
    """Each text's features, and that of the term with which it is seen a second time (0 for texts with terms of their own)."""
    table, known = WordTable(features, WIDTH), _known()
    term = lambda text: 0 if known.search(text) else features(planted_term(text))[0]
    return lambda texts: [pa.array([_distinct(table, text or "", True) for text in texts], pa.list_(pa.int64())), [term(text or "") for text in texts]]


def _known() -> re.Pattern:
    return re.compile("|".join(map(re.escape, _OTHERS)), re.I)


def _swap_products(shared):
    """For each text: the products of the changes of features in its counterfactuals, as places i, j and sums, and their number."""
    table, chosen, known = WordTable(features, WIDTH), shared.value, _known()

    def products(texts: list) -> list:
        rows = []
        for text in texts:
            sums: Counter = Counter()
            n = 0
            for sentence, other in counterfactuals(text, known):
                n += 1
                old, new = set(_distinct(table, sentence).tolist()), set(_distinct(table, other).tolist())
                change = [(chosen[f], 1.0 if f in old else -1.0) for f in old ^ new if f in chosen]
                for i, x in change:
                    for j, y in change:
                        sums[i, j] += x * y
            rows.append(([i for i, _ in sums], [j for _, j in sums], list(sums.values()), n))
        return list(zip(*rows)) or [[]] * 4

    return products


@dataclass(frozen=True)
class Toxicity:
    features: dict[int, int]  # hash -> place
    weights: np.ndarray
    bias: float
    swapped: int = 0  # pairs of the penalty


def choose(rows: list[np.ndarray], y: np.ndarray, most: int = 2000, least_chi2: float = 20.0) -> dict[int, int]:
    """Features and their places: at most `most` of those that are commoner in class 1, by chi-square against rows of both classes, at
    least_chi2 or over, and those of length. None without both classes."""
    n, ones = len(y), int(y.sum())
    if not 0 < ones < n:
        return {}
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    names, place = np.unique(np.concatenate(rows), return_inverse=True)
    a = np.bincount(place, y[owner], len(names))  # class 1 with it
    b = np.bincount(place, 1 - y[owner], len(names))
    chi2 = n * (a * (n - ones - b) - b * (ones - a)) ** 2 / np.maximum(1e-9, ones * (n - ones) * (a + b) * (n - a - b))
    good = np.flatnonzero((a * (n - ones) > b * ones) & (chi2 >= least_chi2))
    good = good[np.lexsort((names[good], -chi2[good]))][:most]
    good = np.union1d(good, np.flatnonzero(np.isin(names, LENGTHS)))
    return {int(names[j]): k for k, j in enumerate(good)}


def fit(rows: list[np.ndarray], y: np.ndarray, chosen: dict[int, int], products: dict[tuple[int, int], float] | None = None, swapped: int = 0, l2: float = 1e-4, swap: float = 1.0, steps: int = 400) -> Toxicity:
    """Logistic loss with equal class weights, plus l2 |w|^2, plus swap times the mean square of the score change of a swap.

    products: for places i, j the sum over all swaps of the products of their changes; swapped: the number of swaps. A mean square
    of changes needs no more of them. Without both classes the score is the share of class 1, or 0.5 without any row.
    """
    n, ones = len(y), int(y.sum())
    if not 0 < ones < n:
        share = min(max(ones / n, 1e-6), 1 - 1e-6) if n else 0.5
        return Toxicity({}, np.zeros(0), float(np.log(share / (1 - share))))
    found = [np.array([chosen[f] for f in r.tolist() if f in chosen], np.int64) for r in rows]
    row, col = np.repeat(np.arange(n), [len(f) for f in found]), np.concatenate(found)  # the ones of the sparse 0/1 matrix
    at = np.array(list(products or ()), np.int64).reshape(-1, 2)
    value = np.array(list((products or {}).values()), float)
    weight = np.where(y == 1, 0.5 / ones, 0.5 / (n - ones))
    w, bias = np.zeros(len(chosen)), 0.0
    m, v, rate = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1), 0.1
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[col], n) + bias, -30, 30)))
        g = weight * (p - y)
        moved = np.bincount(at[:, 0], value * w[at[:, 1]], len(chosen))
        gradient = np.append(np.bincount(col, g[row], len(chosen)) + l2 * w + 2 * swap / max(1, swapped) * moved, g.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return Toxicity(chosen, w.astype(np.float32), float(bias), swapped)


def train(docs: DataFrame, labels: DataFrame, keep, rows: int = 2000, label: str = "toxic", key: str = "doc_id", text: str = "text", scratch: Scratch | None = None, swap: float = 1.0) -> Toxicity:
    """A model from about `rows` labelled documents of each class (the bound on what the driver gets), whole texts, those that keep holds for.

    Each text without identity terms counts a second time with one of them, label as before, so a mention by itself tells nothing of the label; and
    its sentences give pairs in which such a term is swapped (counterfactuals), whose change of score is what the model is penalised for.
    Pairs stay in the tasks: of them the driver gets sums of products by pairs of features, so at most the square of the number of
    features that identity terms have.
    """
    spark = docs.sparkSession
    sample = (scratch or Scratch(spark)).save(labelled_sample(docs, labels, label, keep, rows, key, text), "labelled")
    got = map_texts(sample, _sample_features, [StructField("own", ArrayType(LongType())), StructField("term", LongType())], (key, "y"), text).toArrow().sort_by(key)
    own = got.column("own").combine_chunks()
    flat, at = own.flatten().to_numpy(), np.concatenate([[0], np.cumsum(own.value_lengths().to_numpy())]).astype(int) if len(own) else np.zeros(1, int)
    found, y = [flat[a:b] for a, b in zip(at, at[1:])], got.column("y").to_numpy()
    chosen = choose(found, y)
    term = got.column("term").to_numpy()
    if chosen:
        chosen |= {f: len(chosen) + k for k, f in enumerate(f for f in sorted({features(t)[0] for t in _OTHERS}) if f not in chosen)}
    shared = spark.sparkContext.broadcast(chosen)
    fields = [StructField("i", ArrayType(IntegerType())), StructField("j", ArrayType(IntegerType())), StructField("v", ArrayType(DoubleType())), StructField("n", LongType())]
    swaps_of = map_texts(sample, partial(_swap_products, shared), fields, (key,), text)
    swaps_of = (scratch or Scratch(spark)).save(swaps_of.where("n > 0"), "swaps")
    sums = swaps_of.select(F.inline(F.arrays_zip("i", "j", "v"))).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    swapped = swaps_of.agg(F.sum("n")).first()[0] or 0
    again = np.flatnonzero(term)
    rows_ = found + [np.append(found[k], term[k]) for k in again.tolist()]
    return fit(rows_, np.concatenate([y, y[again]]), chosen, {(r["i"], r["j"]): r["v"] for r in sums}, swapped, swap=swap)


def _scorer(shared):
    model: Toxicity = shared.value

    known = model.features

    def places(word: str) -> tuple | None:
        return tuple([known[f] for f in features(word) if f in known]) or None

    get = Memo(places).__getitem__

    def score(texts: list) -> list:
        out = []
        for text in texts:
            words = distinct_words(text or "")
            found = set(map(get, words))
            found.discard(None)
            at = {k for ks in found for k in ks}.union(model.features[f] for f in lengths(len(words)) if f in model.features)
            z = model.bias + float(model.weights[sorted(at)].sum(dtype=np.float64)) if at else model.bias
            out.append(float(1 / (1 + np.exp(-np.clip(z, -500, 500)))))
        return [out]

    return score


def score_toxicity(docs: DataFrame, model: Toxicity, text: str = "text", keys: tuple = ("doc_id",)) -> DataFrame:
    """keys and score (0 to 1, higher: class 1 likelier) of each whole text; null and empty texts get the bias's score. A text's
    distinct words are held at once.

    The model's size is bounded by its number of features. Repeated rows each give a row, an empty table gives none; further
    columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_texts(docs, partial(_scorer, shared), [StructField("score", DoubleType())], keys, text)
