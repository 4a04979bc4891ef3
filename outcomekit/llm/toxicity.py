"""Toxicity by a weighted finite-state pattern grammar (operator 7).

Words are mapped to symbols (insult, threat verb, target, negation, reporting
verb, agent, modal, plain).  Small transducers read a clause's symbols and
emit weights; their composition scores a matched clause:

* insult: the learned weight of the word's stem,
* threat: agent, modal, threat verb, target, in that order,
* target: an insult near a person addressed counts more,
* negation: an insult in the scope of a negation counts less,
* reported speech: what follows a reporting verb in the clause counts less.

Insult stems are induced from labelled documents: word beginnings whose
document frequency in toxic documents is significantly higher.  A document's
score is a logistic function of its clauses' scores, fitted on labelled
documents that the stems were not taken from.  Both use a bounded sample of
labelled rows (``TRAIN_ROWS``); scoring covers every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomekit.llm.common import numbered, renamed_back, table
from outcomekit.llm.shingles import mix64, shingle_sets

TRAIN_ROWS = 20_000          # labelled rows used at most, by hash order
MAX_STEMS = 200_000          # significant stems, read by the driver; more raise an error
STEM_BLOCK = 200_000         # distinct stems that a task counts before it hands the counts on
STEM_CHARS = range(3, 13)    # length of a stem
LEAST_TOXIC = 3              # toxic documents that a stem needs
EVIDENCE = 10.0              # log-likelihood ratio that a stem needs
MOST_WEIGHT = 6.0
MEMO = 400_000

PLAIN, INSULT, THREAT, TARGET, NEGATION, REPORT, AGENT, MODAL, END = range(9)

# Closed-class words of the grammar (en, fr, de, es) and starting insults / threat verbs.
WORDS: dict[int, str] = {
    TARGET: "you your yours u ur yourself tu te toi vous ton ta du dich dir ihr euch dein usted ustedes ti tus him her them they he she",
    NEGATION: "not no never neither nor without isnt arent wasnt dont doesnt didnt cannot ne pas jamais nicht kein keine nie nunca jamás sin",
    REPORT: "said says say wrote writes called calls quoted reported claims claimed told according dit disait écrit sagte schrieb nannte dijo escribió llamó",
    AGENT: "i we im ill well je nous ich wir yo nosotros",
    MODAL: "will shall gonna going must should vais allons werde werden voy vamos",
    THREAT: "kill hurt destroy beat burn stab shoot punch crush murder tuer frapper détruire töten schlagen zerstören matar golpear destruir",
}
SEED_INSULTS = "idiot moron stupid loser pathetic scum worthless trash clown disgusting imbecile dumb fool jerk"
SEED_WEIGHT = 3.0
# Weights of the document model when there is nothing to learn from: bias, strongest clause, all clauses, kinds, density.
DEFAULT_MODEL = (-3.0, 0.6, 0.8, 0.3, 0.3)

TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]")


# ---- transducers --------------------------------------------------------

@dataclass(frozen=True)
class Transducer:
    """``move(state, symbol) -> (state, factor)``; the factor is emitted on the symbol read."""

    start: object
    move: Callable[[object, int], tuple[object, float]]


def compose(a: Transducer, b: Transducer) -> Transducer:
    """Both read the same symbols; states pair up, factors multiply."""
    seen: dict[tuple[object, int], tuple[object, float]] = {}

    def move(state, symbol):
        got = seen.get((state, symbol))
        if got is None:
            (sa, fa), (sb, fb) = a.move(state[0], symbol), b.move(state[1], symbol)
            got = seen[(state, symbol)] = ((sa, sb), fa * fb)
        return got

    return Transducer((a.start, b.start), move)


def _scope(trigger: int, reach: int, factor: float) -> Transducer:
    """After ``trigger``, an insult among the next ``reach`` words is scaled."""
    def move(left, symbol):
        if symbol == trigger:
            return reach, 1.0
        return max(0, left - 1), factor if left and symbol in (INSULT, THREAT) else 1.0
    return Transducer(0, move)


NEGATED = _scope(NEGATION, 3, 0.25)
REPORTED = _scope(REPORT, 10_000, 0.5)
ADDRESSED = _scope(TARGET, 6, 1.5)
CONTEXT = compose(NEGATED, REPORTED)


def _threat_move(state: int, symbol: int) -> tuple[int, float]:
    # 0 nothing, 1 agent, 2 agent + modal, 3 verb; from 3 a target completes the threat
    if symbol == AGENT:
        return 1, 0.0
    if state == 1 and symbol == MODAL:
        return 2, 0.0
    if state in (1, 2) and symbol == THREAT:
        return 3, 0.0
    if state == 3 and symbol == TARGET:
        return 0, 4.0
    return state, 0.0


THREATENED = Transducer(0, _threat_move)


def clause_score(symbols: list[int], weights: list[float]) -> float:
    """Weight of one clause; 0 if nothing matches."""
    toward = [1.0] * len(symbols)
    for order in (range(len(symbols)), range(len(symbols) - 1, -1, -1)):    # a target before or after
        state = ADDRESSED.start
        for i in order:
            state, f = ADDRESSED.move(state, symbols[i])
            toward[i] = max(toward[i], f)
    total, context, threat = 0.0, CONTEXT.start, THREATENED.start
    for i, s in enumerate(symbols):
        context, f = CONTEXT.move(context, s)
        threat, t = THREATENED.move(threat, s)
        total += t * f
        if s == INSULT:
            total += weights[i] * f * toward[i]
    return total


# ---- words to symbols ---------------------------------------------------

class Lexicon(dict):
    """token -> (symbol, weight), None for a plain word; looks a word's longest
    known stem up once and remembers it."""

    def __init__(self, stems: dict[str, float]):
        super().__init__()
        self.stems = stems
        self.fixed = {w: (symbol, 0.0) for symbol, text in WORDS.items() for w in text.split()}
        self.fixed.update((c, (END, 0.0)) for c in ".!?;\n")
        self.lengths = sorted({len(s) for s in stems}, reverse=True)

    def __missing__(self, word: str):
        w, got = self.stems.get(word + "$"), None
        if w is None:
            w = next((self.stems[word[:n]] for n in self.lengths if n < len(word) and word[:n] in self.stems), None)
        if w is not None:
            got = (INSULT, w)
        got = got or self.fixed.get(word)
        if len(self) > MEMO:
            self.clear()
        self[word] = got
        return got


def features(text: str, lexicon: Lexicon) -> tuple[float, float, float, float]:
    """Strongest clause, log of all clauses, log of distinct insults, matched share of the words."""
    tokens = TOKEN.findall(text.lower())
    marks = [lexicon[t] for t in tokens]
    if not any(m and m[0] in (INSULT, THREAT) for m in marks):
        return 0.0, 0.0, 0.0, 0.0
    best, total, matched = 0.0, 0.0, 0
    kinds: set[str] = set()
    lo = 0
    for hi in [i for i, m in enumerate(marks) if m and m[0] == END] + [len(marks)]:
        clause = marks[lo:hi]
        if any(m and m[0] in (INSULT, THREAT) for m in clause):
            score = clause_score([m[0] if m else PLAIN for m in clause], [m[1] if m else 0.0 for m in clause])
            best, total = max(best, score), total + score
            for t, m in zip(tokens[lo:hi], clause):
                if m and m[0] == INSULT:
                    matched += 1
                    kinds.add(t)
        lo = hi + 1
    return best, math.log1p(total), math.log1p(len(kinds)), 100.0 * matched / len(tokens)


# ---- learning -----------------------------------------------------------

def _stems_of(text: str) -> set[str]:
    """Beginnings of the words, and the words themselves with the end mark "$"
    (so that a short word is no evidence for the longer ones that begin so)."""
    words = set(re.findall(r"[^\W\d_]+", text.lower()))
    return {w[:n] for w in words for n in STEM_CHARS if n < len(w)} | {w + "$" for w in words if len(w) in STEM_CHARS}


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial document frequencies: stem, toxic documents, clean documents."""
    def block() -> pa.RecordBatch:
        stems = list(counts[0].keys() | counts[1].keys())
        return pa.record_batch([pa.array(stems, pa.string()), *[pa.array([c[s] for s in stems], pa.int64()) for c in (counts[1], counts[0])]],
                               names=["stem", "a", "b"])

    counts: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
    for batch in batches:
        for text, y in zip(batch.column("t").to_pylist(), batch.column("y").to_pylist()):
            counts[y].update(_stems_of(text))
            if len(counts[0]) + len(counts[1]) > STEM_BLOCK:
                yield block()
                counts = (Counter(), Counter())
    if counts[0] or counts[1]:
        yield block()


def significant_stems(texts: DataFrame, n_toxic: int, n_clean: int) -> tuple[dict[str, int], dict[str, int]]:
    """Toxic and clean document frequencies of the stems that pass the tests of
    ``choose_stems``, which are applied before anything reaches the driver."""
    counted = (texts.select("t", "y").mapInArrow(_count_stems, "stem string, a long, b long")
               .groupBy("stem").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    base, a, b = n_toxic / (n_toxic + n_clean), F.col("a"), F.col("b")
    ratio = a * F.log(a / (a + b) / base) + F.when(b > 0, b * F.log(b / (a + b) / (1 - base))).otherwise(0.0)
    w = F.log((a + 0.5) / (n_toxic + 1)) - F.log((b + 0.5) / (n_clean + 1))
    # a little below the bounds: choose_stems decides
    rows = counted.where((a >= LEAST_TOXIC) & (ratio >= EVIDENCE - 1e-6) & (w >= 1.0 - 1e-6)).limit(MAX_STEMS + 1).collect()
    if len(rows) > MAX_STEMS:
        raise ValueError(f"more than {MAX_STEMS} significant stems")
    rows.sort(key=lambda r: r["stem"])
    return {r["stem"]: r["a"] for r in rows}, {r["stem"]: r["b"] for r in rows}


def choose_stems(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Stems with significantly more toxic than clean documents -> log-odds.
    Of stems in one word, a longer one stays only if it says more."""
    base = n_toxic / (n_toxic + n_clean)
    weight: dict[str, float] = {}
    for s, a in toxic.items():
        b = clean.get(s, 0)
        share = a / (a + b)
        ratio = a * math.log(share / base) + (b * math.log((1 - share) / (1 - base)) if b else 0.0)
        w = math.log((a + 0.5) / (n_toxic + 1)) - math.log((b + 0.5) / (n_clean + 1))
        if ratio >= EVIDENCE and w >= 1.0:
            weight[s] = min(w, MOST_WEIGHT)
    keep: dict[str, float] = {}
    for s in sorted(weight, key=lambda s: (len(s), s)):
        above = next((s[:n] for n in range(len(s) - 1, 2, -1) if s[:n] in keep), None)
        if above and toxic[above] == toxic[s] and clean.get(s, 0) <= clean.get(above, 0):
            del keep[above]                                  # the same documents: the longer stem is safer
            keep[s] = weight[s]
        elif not above or weight[s] > keep[above] + 0.5:
            keep[s] = weight[s]
    return keep


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> tuple[float, ...]:
    """Bias and weights by Newton steps with a ridge on the weights.  A match
    never speaks against toxicity: features with a negative weight are left out
    (weight 0) and the others fitted again."""
    used = list(range(x.shape[1]))
    while True:
        a = np.column_stack((np.ones(len(x)), x[:, used]))
        w, penalty = np.zeros(a.shape[1]), np.diag([1e-3] + [ridge] * len(used))
        w[0] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (y - p) - penalty @ w)
            w += np.clip(step, -1, 1)
            if np.abs(step).max() < 1e-8:
                break
        if not used or (w[1:] >= 0).all():
            break
        used.pop(int(w[1:].argmin()))
    out = np.zeros(x.shape[1])
    out[used] = w[1:]
    return (float(w[0]), *out.tolist())


@dataclass(frozen=True)
class Model:
    stems: dict[str, float]
    weights: tuple[float, ...]


def held_out(id_col: F.Column) -> F.Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``rows`` labelled rows outside the held-out fold (the
    first ones in the order of a hash of the id).

    Rows without an id, a text's copies and further texts of one id take no
    part; without toxic or without clean rows the model is ``DEFAULT_MODEL``.
    The same rows in any order give the same model."""
    key = F.col(f"`{id_col}`").cast("long")
    chosen = (labels.select(key.alias("i"), F.col(f"`{label_col}`").cast("int").alias("y"))
              .where(F.col("i").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("i")))
              .orderBy(F.xxhash64("i"), "i", "y").limit(rows))
    # at most ``rows`` rows of two numbers
    sample = (docs.select(key.alias("i"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
              .join(F.broadcast(chosen), "i"))
    sample = sample.mapInArrow(_with_signatures, "i long, t string, y int, m1 long, m2 long")
    # one document of a group of near copies, else the group's words look like evidence; one text of an id:
    # at most ``rows`` rows.  The smallest (id, text) stays, whatever the order of the rows
    for by in ("m1", "m2", "i"):
        first = F.min(F.struct("i", "t", "y", "m1", "m2")).alias("r")
        sample = sample.groupBy(F.col(by).alias("_by")).agg(first).select("r.*")
    sample = sample.select("i", "t", "y", F.pmod(F.xxhash64("i"), F.lit(3)).alias("part")).persist()
    try:
        n = {(bool(r["s"]), r["y"]): r["count"] for r in sample.groupBy((F.col("part") > 0).alias("s"), "y").count().collect()}
        seeds = {w + "$": SEED_WEIGHT for w in SEED_INSULTS.split()}
        n_toxic, n_clean = n.get((True, 1), 0), n.get((True, 0), 0)
        stems: dict[str, float] = {}
        if n_toxic and n_clean:
            stems = choose_stems(*significant_stems(sample.where("part > 0"), n_toxic, n_clean), n_toxic, n_clean)
        stems = seeds | stems
        # the third that gave no stems calibrates; with few rows, all of them do
        fit_on = sample if min(n.get((False, 1), 0), n.get((False, 0), 0)) < 10 else sample.where("part = 0")
        table_ = fit_on.mapInArrow(_feature_rows(stems), "y int, a double, b double, c double, d double").toPandas()
        table_ = table_.sort_values(list("yabcd"))               # sums of floats don't follow the order of the rows
        y = table_["y"].to_numpy(float)
        if not 0 < y.sum() < len(y):
            return Model(stems, DEFAULT_MODEL)
        return Model(stems, fit_logistic(table_[list("abcd")].to_numpy(float), y))
    finally:
        sample.unpersist()


def _with_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two minima of hashes over word shingles: near copies mostly share them."""
    for b in batches:
        low = np.zeros((2, b.num_rows), np.uint64)
        for i, s in shingle_sets(b.column("t").cast(pa.binary())):
            if len(s):
                low[:, i] = s[0], mix64(s + np.uint64(1)).min()
        signed = low.view(np.int64)
        yield pa.record_batch([b.column("i"), b.column("t"), b.column("y"), pa.array(signed[0]), pa.array(signed[1])],
                              names=["i", "t", "y", "m1", "m2"])


def _feature_rows(stems: dict[str, float]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(stems)
        for b in batches:
            f = np.array([features(t, lexicon) for t in b.column("t").to_pylist()], float).reshape(-1, 4)
            yield pa.record_batch([b.column("y"), *[pa.array(f[:, k]) for k in range(4)]], names=list("yabcd"))
    return rows


def _score(model: Model, names: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, w = Lexicon(model.stems), np.array(model.weights)
        for b in batches:
            f = np.array([features(t, lexicon) for t in b.column("_text").to_pylist()], float).reshape(-1, 4)
            p = 1 / (1 + np.exp(-np.clip(w[0] + f @ w[1:], -30, 30)))
            yield pa.record_batch([*[b.column(c) for c in names], pa.array(p)], names=[*names, "score"])
    return score


def score(docs: DataFrame, model: Model, columns: list[str], text_col: str = "text") -> DataFrame:
    """``columns`` of ``docs`` plus ``score``; only the text is read by the model.
    Null and empty texts have the score of a text without matches."""
    from pyspark.sql import types as T

    names = [f"c{i}" for i in range(len(columns))]
    src = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)],
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    fields = [T.StructField(f.name, f.dataType, True) for f in src.schema.fields if f.name != "_text"]
    out = src.mapInArrow(_score(model, names), T.StructType([*fields, T.StructField("score", T.DoubleType())]))
    return out.select(*[F.col(n).alias(c) for c, n in zip(columns, names)], "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, learn(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the rest keep all their columns, whatever
    their names.  Repeated rows stay or go together; null and empty texts stay."""
    own, names = numbered(docs)
    model = learn(docs, table(spark, sf_dir, "labels"))
    return renamed_back(score(own, model, own.columns, names["text"]).where("score < 0.5"), names)
