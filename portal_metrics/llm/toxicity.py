"""Operator 3: toxicity by a weighted finite-state grammar of clauses.

Five transducers are composed over the words of a clause: the lexical ones map words
to insult and threat arcs with weights, and to target, negation and reported-speech
symbols; the clause machine below reads these symbols and puts the weight of every
matched insult or threat on one path - plain, targeted, negated or reported.  A
document's score is a logistic function of the weights gathered on each path, so a
clause counts as what it says, not word by word.

Arc weights are log odds learned from labelled rows outside the held-out fold
(words and word beginnings, each group of near copies counted once); seed arcs keep their default until labels
speak about them.  Path coefficients are fitted on the same rows.  Labels, language,
source and id are never inputs of a score.

Bounds: at most SAMPLE_ROWS labelled rows are used (those of least hash), at most
ARCS arcs are kept (highest likelihood ratio).

Defined results: NULL and empty texts get the score of a text without matches; repeated
rows are scored each; without labels of both kinds the seed arcs and default
coefficients are used; empty tables give empty tables; other columns pass through, and
an input column named like the output is replaced.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portal_metrics.llm import common as C

SAMPLE_ROWS = 40_000
ARCS = 4096
THRESHOLD = 0.7
#: An arc needs this much weighted support among toxic rows, these log odds and this likelihood ratio.
SUPPORT, LOG_ODDS, RATIO = 2.5, 2.0, 9.0
#: Lengths of the word beginnings that can be arcs (for inflected insults).
BEGINNINGS = (4, 5, 6)
#: Words between a negation, target or threat and what it belongs to.
NEAR = 4
SEED_WEIGHT = 4.0

# Symbols of the seed transducers (English, German, French, Spanish).
INSULTS = frozenset("idiot moron scum loser stupid trash worthless pathetic disgusting bastard imbecile dumb "
                    "dummkopf trottel abschaum crétin imbécile connard idiota imbécil estúpido".split())
THREATS = frozenset("kill hurt destroy murder strangle beat crush stab shoot burn töten umbringen verletzen "
                    "tuer frapper détruire matar destruir golpear".split())
TARGETS = frozenset("you your yours u he she him her they them his their these those du dich dir ihr euch sie "
                    "tu te toi vous il elle ils elles tú usted ustedes él ella ellos ellas".split())
NEGATIONS = frozenset("not never no neither nor without isn aren wasn don doesn nicht kein keine keinen nie niemals "
                      "pas jamais aucun aucune ni nunca jamás ningún ninguna tampoco".split())
REPORTS = frozenset("said says say reported reports wrote writes quoted quotes claimed claims alleged called "
                    "sagte sagt schrieb berichtet dit écrit déclaré affirme dijo dice escribió afirma".split())

_WORDS = re.compile(r"[^\W_]+")
_CLAUSE = re.compile(r"[.!?;:\n]+")
PATHS = ("plain", "targeted", "negated", "reported")
DEFAULT = np.array([-3.0, 1.0, 1.2, 0.3, 0.3])


def beginnings(word: str) -> list[str]:
    """Arc labels a word can match: itself and, marked by ``*``, its beginnings."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


@dataclass
class Model:
    arcs: dict[str, float] = field(default_factory=dict)
    coefficients: np.ndarray = field(default_factory=DEFAULT.copy)

    def __post_init__(self):
        self._memory: dict[str, float] = {}

    def __getstate__(self):
        return {"arcs": self.arcs, "coefficients": self.coefficients, "_memory": {}}

    def weight(self, word: str) -> float:
        """Weight of the lexical arc of a word (0: no arc)."""
        w = self._memory.get(word)
        if w is None:
            w = max((self.arcs.get(x, 0.0) for x in beginnings(word)), default=0.0)
            if word in INSULTS and word not in self.arcs:
                w = max(w, SEED_WEIGHT)
            if len(self._memory) > 100_000:
                self._memory.clear()
            self._memory[word] = w
        return w

    def clause(self, words: list[str], out: np.ndarray) -> None:
        """Run the composed machine over one clause; add each match's weight to its path."""
        last_negation = last_target = last_threat = -NEAR - 1
        reported = False
        waiting: list[tuple[int, float]] = []  # matches that a target may still follow
        for i, word in enumerate(words):
            if word in REPORTS:
                reported = True
            elif word in NEGATIONS:
                last_negation = i
            elif word in TARGETS:
                last_target = i
                for at, w in waiting:
                    if i - at <= NEAR:
                        out[0] -= w
                        out[1] += w
                waiting = []
                if i - last_threat <= NEAR and not reported and last_threat - last_negation > NEAR:
                    out[1] += SEED_WEIGHT
                    last_threat = -NEAR - 1
            if word in THREATS:
                last_threat = i
            w = self.weight(word)
            if not w:
                continue
            if reported:
                out[3] += w
            elif i - last_negation <= NEAR:
                out[2] += w
            elif i - last_target <= NEAR:
                out[1] += w
            else:
                out[0] += w
                waiting.append((i, w))

    def paths(self, text: str | None) -> np.ndarray:
        """Weight gathered on each path by the clauses of a text."""
        out = np.zeros(len(PATHS))
        if text:
            text = text.lower()
            words = set(_WORDS.findall(text))
            if any(map(self.weight, words)) or not words.isdisjoint(THREATS):
                for clause in _CLAUSE.split(text):
                    self.clause(_WORDS.findall(clause), out)
        return out

    def score(self, text: str | None) -> float:
        z = self.coefficients[0] + float(self.paths(text) @ self.coefficients[1:])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(id_col: str = "doc_id"):
    """The fold that labels are never learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled ids outside the held-out fold, the ids of least hash."""
    wanted = (labels.where(F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("id"))
              .agg(F.max(label_col).cast("int").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(rows))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(wanted), "id").select("text", "toxic")  # bounded by ``rows``


def _grouped(batches):
    """(text, toxic, group): group is the least shingle, which near copies share."""
    for b in batches:
        data, offsets = C.text_bytes(b.column(0), lower=True)
        least = np.zeros(b.num_rows, np.uint64)
        for i, j in C.slices(offsets):
            grams, per = C.text_shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            least[i:j] = C.minhashes(grams, per, 1)[:, 0]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(least.view(np.int64))], ["text", "toxic", "group"])


def _counted(batches):
    """(arc, toxic, clean): weighted rows that hold each arc label, summed in the task."""
    total: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0])

    def flush():
        arcs = list(total)
        yield pa.RecordBatch.from_arrays([pa.array(arcs, pa.string()), pa.array([total[a][0] for a in arcs], pa.float64()),
                                          pa.array([total[a][1] for a in arcs], pa.float64())], ["arc", "toxic", "clean"])
        total.clear()

    for b in batches:
        for text, toxic, weight in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            side = 0 if toxic else 1
            for arc in {x for w in set(_WORDS.findall((text or "").lower())) for x in beginnings(w)}:
                total[arc][side] += weight
            if len(total) > 150_000:
                yield from flush()
    yield from flush()


def _likelihood_ratio(a, b, na, nb):
    """Half the G statistic of a rows of na against b rows of nb, as a column."""
    p = (a + b) / (na + nb)
    return a * F.log((a + F.lit(1e-9)) / (na * p)) + F.when(b > 0, b * F.log(b / (nb * p))).otherwise(0.0)


def _fit(x: np.ndarray, y: np.ndarray, steps: int = 3000, decay: float = 1e-3) -> np.ndarray:
    """Logistic regression by projected gradient: path coefficients stay positive, negated and reported ones below plain."""
    x = np.minimum(x, 20.0)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    c, v = DEFAULT.copy(), np.zeros(len(DEFAULT))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(c[0] + x @ c[1:], -30, 30)))
        e = weight * (p - y)
        g = np.concatenate([[e.sum()], e @ x]) + decay * (c - DEFAULT)
        v = 0.9 * v - 0.05 * g
        c = c + v
        c[1:3] = np.maximum(c[1:3], 0.05)
        c[3:] = np.clip(c[3:], 0.0, 0.5 * c[1])
    return c


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        rows: int = SAMPLE_ROWS, arcs: int = ARCS) -> Model:
    """Learn arc weights and path coefficients from labelled rows outside the held-out fold."""
    sample = C.saved(training_rows(docs, labels, id_col, text_col, label_col, rows)
                     .mapInArrow(_grouped, "text string, toxic int, group long"))
    weights = sample.groupBy("group").agg((1.0 / F.count("*")).alias("weight"))
    weighed = C.saved(sample.join(F.broadcast(weights), "group").select("text", "toxic", "weight"))  # bounded by ``rows``
    n = {r["toxic"]: r["w"] for r in weighed.groupBy("toxic").agg(F.sum("weight").alias("w")).collect()}
    if not n.get(0) or not n.get(1):
        return Model()
    counts = weighed.mapInArrow(_counted, "arc string, toxic double, clean double").groupBy("arc").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (n[1] + 1)) - F.log((F.col("b") + 0.5) / (n[0] + 1))
    found = (counts.where(F.col("a") >= SUPPORT).withColumn("w", odds)
             .withColumn("ratio", _likelihood_ratio(F.col("a"), F.col("b"), F.lit(n[1]), F.lit(n[0])))
             .where((F.col("w") >= LOG_ODDS) & (F.col("ratio") >= RATIO)).orderBy(F.desc("ratio"), "arc").limit(arcs).collect())
    spoken = {r["arc"]: float(r["w"]) for r in counts.where(F.col("arc").isin(*INSULTS)).withColumn("w", odds).collect()}
    model = Model({**{k: max(0.0, w) for k, w in spoken.items()}, **{r["arc"]: float(r["w"]) for r in found}})

    def features(batches):
        for b in batches:
            x = [model.paths(t).tolist() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1)], ["x", "y"])

    got = weighed.select("text", "toxic").mapInArrow(features, "x array<double>, y int").collect()  # at most ``rows`` short rows
    model.coefficients = _fit(np.array([r["x"] for r in got]), np.array([r["y"] for r in got]))
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``, the toxicity of the whole text (0 to 1)."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == out.lower()])
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most ARCS arcs

    def work(batches):
        m = shared.value
        for b in batches:
            scores = [m.score(t) for t in b.column(b.schema.get_field_index(text_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], [*b.schema.names, out])

    return docs.mapInArrow(work, schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = C.documents(spark, sf_dir)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
