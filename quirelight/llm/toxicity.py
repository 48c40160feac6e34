"""Toxicity by a weighted finite-state pattern grammar.

The lexicon transducer reads a clause's words and writes classes with weights. Its insult arcs accept whole words, stems
of 3 to 7 letters and phrases of two words and carry log-odds learned from labels; SEED words have SEED_WEIGHT as a
prior worth SEED_DOCS documents. Threats, targets, negations and verbs of saying are short lists of words and phrases.

The clause machine is made by composition (compose()) from transducers of their own:

* AHEAD reads from the right and marks each class with whether a target follows within TARGET_SPAN words;
* BEHIND does so from the left, and joins both to `aimed`;
* NEGATION marks what stands within NEGATION_SPAN words after a negation;
* REPORTED marks what follows a verb of saying, to the clause's end;
* EMIT lets insults, and threats that are aimed, leave with the state they were read in, and nothing else.

What leaves counts its weight times the factors of its state, none of which is 1, and a clause's score is the sum of
that: clauses are scored, not words. Both passes are linear in the clause's length.

A document's score is a logistic function of its highest clause and of the log of its sum. Arcs, the least log-odds of
an arc (from ODDS), state factors (from FACTORS) and the logistic function (about PRIOR, by which alone it goes without
labels) are fitted by likelihood on SAMPLE labelled documents of each class at most, the first by a hash of doc_id; each
of these is scored with its own label taken out of the arcs' counts. Near copies among them, by any of FAMILIES least
hashes of five words, count once. Clean documents are weighted up to their number. Every document is then scored over
its whole text.

Cases: a null or empty text has no clauses and gets the score of the constant; very long texts and clauses are read
whole, in linear time; labels of null are left out; if a doc_id has several labels the highest holds; labels without a
document and documents without a label are fine; of equally likely settings the first is taken; rows that repeat a
doc_id are scored apart; an empty table gives no rows; columns other than those named are ignored.
"""

from __future__ import annotations

import itertools
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelight.llm.common import bounded, held_out, narrow, small_batches, stored, utf8
from quirelight.llm.text_hash import WORD, Ranges, mix, runs, words

SAMPLE = 6000
FAMILIES = 3
STEMS = range(3, 8)
EVIDENCE = 12.0  # likelihood ratio that an arc must reach, or more where many arcs are tried
ODDS = (1.0, 2.0, 3.0, 4.0)
NEGATION_SPAN, TARGET_SPAN = 3, 3
FACTORS = {"negation": (0.3, 0.6, 0.9), "reported": (0.3, 0.6, 0.9), "target": (1.1, 1.4)}
SEED_WEIGHT, SEED_DOCS = 4.0, 2.0
PRIOR = (-3.0, 1.0, 0.5)
MEMO = 400_000
HELD = 300_000

SEED = "idiot moron stupid scum trash loser worthless pathetic disgusting idiota imbecile dummkopf abschaum connard".split()
THREAT = ["kill", "hurt", "destroy", "strangle", "stab", "beat", "burn", "töten", "umbringen", "tuer", "frapper", "matar", "golpear", "beat up", "wipe out"]
TARGET = "you your yours u thou du dich dir ihr euch tu toi te vous tú ti usted ustedes vosotros".split()
NEGATION = ["not", "never", "no", "isn't", "aren't", "don't", "nicht", "kein", "keine", "nie", "pas", "jamais", "nunca", "jamás", "tampoco", "far from", "no longer"]
REPORTED = ["said", "says", "saying", "wrote", "writes", "quoted", "claimed", "alleged", "sagte", "schrieb", "laut", "déclaré", "écrit", "dijo", "escribió", "according to", "selon lui", "según él"]
TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;:\n]")
BREAKS = frozenset(".!?;:\n")
CLASSES = ("other", "insult", "threat", "target", "negation", "reported")
N_STATES = 8


class Transducer:
    """Deterministic, a symbol out for a symbol in. arcs: (state, symbol in) to (state, symbol out); state 0 is first."""

    def __init__(self, arcs: dict[tuple, tuple]):
        self.arcs = arcs

    @classmethod
    def of(cls, states: range, symbols, step) -> Transducer:
        return cls({(s, x): step(s, x) for s in states for x in symbols})

    def outputs(self) -> list:
        return sorted({out for _, out in self.arcs.values()})

    def inputs(self) -> list:
        return sorted({x for _, x in self.arcs})


def compose(a: Transducer, b: Transducer, first=(0, 0)) -> Transducer:
    """b reads what a writes; states are pairs, those that can be reached from the first."""
    arcs, todo, seen = {}, [first], {first}
    while todo:
        p, q = todo.pop()
        for x in a.inputs():
            if (p, x) in a.arcs:
                p2, middle = a.arcs[p, x]
                q2, out = b.arcs[q, middle]
                arcs[(p, q), x] = (p2, q2), out
                if (p2, q2) not in seen:
                    seen.add((p2, q2))
                    todo.append((p2, q2))
    return Transducer(arcs)


def countdown(span: int, opens: str, symbols, mark) -> Transducer:
    """State: for how many words what the opening class opened lasts. mark(symbol, whether it lasts) is written."""
    return Transducer.of(range(span + 1), symbols, lambda s, x: (span if (x[0] if isinstance(x, tuple) else x) == opens else max(0, s - 1), mark(x, s > 0)))


AHEAD = countdown(TARGET_SPAN, "target", CLASSES, lambda x, on: (x, on))
BEHIND = countdown(TARGET_SPAN, "target", AHEAD.outputs(), lambda x, on: (x[0], x[1] or on))
_NEGATED = countdown(NEGATION_SPAN, "negation", BEHIND.outputs(), lambda x, on: (*x, on))
_REPORTED = Transducer.of(range(2), _NEGATED.outputs(), lambda s, x: (int(s or x[0] == "reported"), (*x, bool(s))))
_EMIT = Transducer.of(range(1), _REPORTED.outputs(), lambda s, x: (0, x[2] + 2 * x[3] + 4 * x[1] if x[0] == "insult" or (x[0] == "threat" and x[1]) else -1))


def _numbered(machine: Transducer, first, symbols: list) -> tuple[list[list[int]], list[list]]:
    """The machine as lists by state and symbol number: next state, output."""
    states = [first, *sorted({s for s, _ in machine.arcs} - {first})]
    at = {s: i for i, s in enumerate(states)}
    return [[at[machine.arcs[s, x][0]] for x in symbols] for s in states], [[machine.arcs[s, x][1] for x in symbols] for s in states]


_MARKED = AHEAD.outputs()
_RIGHT_NEXT, _right = _numbered(AHEAD, 0, list(CLASSES))
_RIGHT_OUT = [[_MARKED.index(x) for x in row] for row in _right]
_FIRST = (((0, 0), 0), 0)
_LEFT_NEXT, _LEFT_OUT = _numbered(compose(compose(compose(BEHIND, _NEGATED), _REPORTED, ((0, 0), 0)), _EMIT, _FIRST), _FIRST, _MARKED)
_KIND = {name: i for i, name in enumerate(CLASSES)}


def arcs_of(word: str) -> list[str]:
    """The names of the lexicon's arcs that could accept a word: its stems, and the whole word."""
    return [word[:n] + "*" for n in STEMS if n < len(word)] + [word]


def phrases_of(found: list[str]) -> set[str]:
    """Pairs of neighbouring words of one clause."""
    return {f"{a} {b}" for a, b in zip(found[:-1], found[1:], strict=True) if a not in BREAKS and b not in BREAKS}


def odds_of(t, c, toxic: float, clean: float):
    return np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1))


def weight(t, c, toxic: float, clean: float, evidence: float, least: float):
    """Smoothed log-odds of arcs in t toxic and c clean documents, 0 where they or the evidence are too thin."""
    t, c = np.maximum(np.asarray(t, float), 0), np.maximum(np.asarray(c, float), 0)
    n = t + c
    log = lambda x: np.log(np.maximum(x, 1e-12))
    ratio = 2 * (t * (log(t) - log(n * toxic / (toxic + clean))) + c * (log(c) - log(n * clean / (toxic + clean))))
    odds = odds_of(t, c, toxic, clean)
    return np.where((ratio >= evidence) & (odds > least), odds, 0.0)


class Grammar:
    """The lexicon and the clause machine. own: +1, 0 or -1 takes a toxic, no or a clean document out of the counts."""

    def __init__(self, arcs: dict[str, tuple[int, int]], toxic: int, clean: int, tried: int, least: float = ODDS[-2]):
        self.made = arcs, toxic, clean, tried, least
        evidence = max(EVIDENCE, 2 * math.log(max(1, tried)))  # as many arcs are tried
        # a stem is kept only for what its most frequent continuation leaves over
        longer: dict[str, tuple[int, int]] = {}
        single = {a: x for a, x in arcs.items() if " " not in a}
        for a, counts in single.items():
            for stem in arcs_of(a.rstrip("*"))[:-1]:
                if stem != a and counts > longer.get(stem, (0, 0)):
                    longer[stem] = counts
            if a.endswith("*") and (whole := single.get(a[:-1], (0, 0))) > longer.get(a, (0, 0)):
                longer[a] = whole
        left = [(x[0] - longer.get(a, (0, 0))[0], x[1] - longer.get(a, (0, 0))[1]) for a, x in arcs.items()]
        useful = weight([x[0] for x in left], [x[1] for x in left], max(1, toxic), max(1, clean), evidence, least) > 0 if arcs else []
        arcs = {a: x for (a, x), u in zip(arcs.items(), useful, strict=True) if u}
        # a phrase of which a word is an arc itself adds nothing
        arcs = {a: x for a, x in arcs.items() if " " not in a or not any(p in arcs for w in a.split(" ") for p in arcs_of(w))}
        self.weights = [{}, {}, {}]
        for own in (0, 1, -1):
            t = np.array([x[0] for x in arcs.values()], float) - (own == 1)
            c = np.array([x[1] for x in arcs.values()], float) - (own == -1)
            totals = max(1, toxic - (own == 1)), max(1, clean - (own == -1))
            w = weight(t, c, *totals, evidence, least) if arcs else []
            self.weights[own] = {k: float(x) for k, x in zip(arcs, w, strict=True) if x > 0}
            for word in SEED:
                t, c = self.made[0].get(word, (0, 0))
                t, c = max(0, t - (own == 1)), max(0, c - (own == -1))
                blended = (SEED_DOCS * SEED_WEIGHT + (t + c) * float(odds_of(t, c, *totals))) / (SEED_DOCS + t + c)
                if blended > self.weights[own].get(word, 0.0):
                    self.weights[own][word] = blended
        lists = [(w, kind) for kind, found in (("threat", THREAT), ("target", TARGET), ("negation", NEGATION), ("reported", REPORTED)) for w in found]
        self.lists = {w: kind for w, kind in lists if " " not in w}
        self.phrases = [{a: x for a, x in known.items() if " " in a} | {w: kind for w, kind in lists if " " in w} for known in self.weights]
        self.heads = [{a.split(" ")[0] for a in found} for found in self.phrases]
        self.memo: list[dict] = [{}, {}, {}]

    def read(self, word: str, own: int):
        """What the lexicon writes for a word: an insult's weight, the name of another class, or None."""
        known = self.weights[own]
        found = max((known.get(a, 0.0) for a in arcs_of(word)), default=0.0)
        return found or self.lists.get(word)

    def classes(self, found: list[str], own: int) -> list:
        """What the lexicon writes for each word; for a phrase, at its last word."""
        memo = self.memo[own]
        if len(memo) > MEMO:
            memo.clear()
        for w in set(found).difference(memo):
            memo[w] = self.read(w, own)
        out = list(map(memo.__getitem__, found))
        if not self.heads[own].isdisjoint(found):
            known, heads = self.phrases[own], self.heads[own]
            for i in [i for i, w in enumerate(found[:-1]) if w in heads]:
                if (x := known.get(f"{found[i]} {found[i + 1]}")) is not None:
                    out[i + 1] = x
        return out

    def document(self, text: str, own: int = 0) -> np.ndarray | None:
        """Matched clauses (rows) by state (bits: negation, reported, target): the weight that left the machine."""
        found = TOKEN.findall(text.lower())
        classes = self.classes(found, own)
        hits = [i for i, x in enumerate(classes) if x is not None and (x.__class__ is float or x == "threat")]
        if not hits:
            return None
        borders = [-1, *[i for i, w in enumerate(found) if w in BREAKS], len(found)]
        clauses, k = [], 0
        for a, b in zip(borders[:-1], borders[1:], strict=True):
            if k < len(hits) and hits[k] < b:
                clauses.append(self.clause(classes[a + 1 : b]))
                while k < len(hits) and hits[k] < b:
                    k += 1
        return np.array(clauses)

    @staticmethod
    def clause(classes: list) -> np.ndarray:
        """One pass from the right, one from the left."""
        out = [0.0] * N_STATES
        kinds = [0 if x is None else 1 if x.__class__ is float else _KIND[x] for x in classes]
        marked, state = [0] * len(kinds), 0
        for i in range(len(kinds) - 1, -1, -1):
            marked[i] = _RIGHT_OUT[state][kinds[i]]
            state = _RIGHT_NEXT[state][kinds[i]]
        state = 0
        for i, x in enumerate(marked):
            emitted = _LEFT_OUT[state][x]
            if emitted >= 0:
                out[emitted] += classes[i] if kinds[i] == 1 else SEED_WEIGHT
            state = _LEFT_NEXT[state][x]
        return np.array(out)


def state_factors(negation: float, reported: float, target: float) -> np.ndarray:
    return np.array([(negation if s & 1 else 1) * (reported if s & 2 else 1) * (target if s & 4 else 1) for s in range(N_STATES)])


def features(clauses: np.ndarray | None, factors: np.ndarray) -> tuple[float, float]:
    if clauses is None or not len(clauses):
        return 0.0, 0.0
    scores = clauses @ factors
    return float(scores.max()), math.log1p(float(scores.sum()))


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, prior=PRIOR, ridge: float = 0.1) -> tuple[np.ndarray, float]:
    """Weighted logistic regression about a prior, by damped Newton steps; and its penalised log-likelihood."""
    x = np.column_stack([np.ones(len(x)), x])
    centre = np.array(prior)
    penalty = ridge * np.array([0.01] + [1.0] * (x.shape[1] - 1))
    at = lambda b: float(w @ (y * (x @ b) - np.logaddexp(0, x @ b)) - penalty @ (b - centre) ** 2 / 2)
    b = centre.copy()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x.T * (w * p * (1 - p))) @ x + np.diag(penalty), x.T @ (w * (y - p)) - penalty * (b - centre))
        size = 1.0
        while size > 1e-4 and at(b + size * step) < at(b):
            size /= 2
        b = b + size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return b, at(b)


def _family(batches):
    """Least hashes of five consecutive words, under FAMILIES hash functions: near copies share one of them nearly
    always."""
    for batch in bounded(batches):
        data, offsets = utf8(batch.column("text"))
        starts, ends, row = words(data, offsets, WORD)
        hashes = Ranges(data).of(starts, ends)
        borders = np.searchsorted(row, np.arange(batch.num_rows + 1))
        least = []
        for lo, hi in zip(borders[:-1], borders[1:], strict=True):
            of = runs(hashes[lo:hi], max(1, min(5, hi - lo)))
            least.append([int(mix(of + np.uint64(k)).min(initial=2**64 - 1)) >> 1 for k in range(FAMILIES)])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("text"), batch.column("toxic"), pa.array(least, pa.list_(pa.int64()))], ["doc_id", "text", "toxic", "families"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[tuple, np.ndarray, np.ndarray]:
    """docs: doc_id, text; labels: doc_id, toxic. Returns what the grammar is made of, the states' factors and the
    logistic weights."""
    spark = docs.sparkSession
    labels = narrow(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r.toxic: r.n for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # 2 rows
    parts = [labels.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]).withColumnRenamed("doc_id", "l_id"))  # 2 * sample rows at most
    rows = docs.join(chosen, docs["doc_id"] == F.col("l_id")).select("doc_id", "text", "toxic").where("text is not null")
    rows = rows.mapInArrow(_family, "doc_id long, text string, toxic int, families array<long>")
    for k in range(FAMILIES):
        rows = rows.groupBy(F.get("families", k)).agg(F.min_by(F.struct("doc_id", "text", "toxic", "families"), "doc_id").alias("one")).select("one.*")
    rows = stored(rows.select("text", "toxic"), "toxicity-sample")

    def count(batches):
        seen: dict[str, list[int]] = {}
        n = [0, 0]

        def flush():
            found = list(seen.items())
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.string()), pa.array([x[1] for _, x in found], pa.int64()), pa.array([x[0] for _, x in found], pa.int64())], ["arc", "t", "c"])

        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                n[y] += 1
                found = TOKEN.findall(text.lower())
                for a in {a for w in set(found) for a in arcs_of(w)} | phrases_of(found):
                    seen.setdefault(a, [0, 0])[y] += 1
                if len(seen) > HELD:
                    yield flush()
        yield flush()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([n[1]], pa.int64()), pa.array([n[0]], pa.int64())], ["arc", "t", "c"])

    summed = rows.mapInArrow(count, "arc string, t long, c long").groupBy("arc").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    several = F.col("arc").isNull() | (F.col("t") >= 2)
    summed = stored(summed.where(several | F.col("arc").isin(SEED)), "toxicity-arcs")  # clean labels outweigh seeds, so theirs stay
    whole = summed.where("arc is null").collect()  # 1 row
    toxic, clean = (int(whole[0].t or 0), int(whole[0].c or 0)) if whole else (0, 0)
    tried = summed.where(several).count()
    # every arc that could have the evidence and odds of the lowest setting, and the seeds; the sample bounds them
    n, all_ = F.col("t") + F.col("c"), max(1, toxic + clean)
    part = lambda x, total: F.when(F.col(x) > 0, F.col(x) * F.log(F.col(x) * all_ / (n * max(1, total)))).otherwise(0.0)
    evident = (2 * (part("t", toxic) + part("c", clean)) >= EVIDENCE - 1e-6) & (F.col("t") * max(1, clean) > F.col("c") * max(1, toxic))
    found = summed.where(F.col("arc").isNotNull() & (evident | F.col("arc").isin(SEED))).orderBy("arc").collect()
    arcs = {r.arc: (int(r.t), int(r.c)) for r in found}
    sent = spark.sparkContext.broadcast((arcs, toxic, clean, tried))

    def described(batches):
        machines = [Grammar(*sent.value, least) for least in ODDS]
        for batch in batches:
            ys, out = batch.column("toxic").to_pylist(), []
            for text, y in zip(batch.column("text").to_pylist(), ys, strict=True):
                one = []
                for machine in machines:
                    clauses = machine.document(text, 1 if y else -1)
                    one += [*clauses.sum(axis=0), *clauses[clauses.sum(axis=1).argmax()]] if clauses is not None else [0.0] * 2 * N_STATES
                out.append(one)
            yield pa.RecordBatch.from_arrays([pa.array(ys, pa.int32()), pa.array(out, pa.list_(pa.float64()))], ["y", "x"])

    got = sorted(rows.mapInArrow(described, "y int, x array<double>").collect())  # 2 * sample rows at most
    y = np.array([r.y for r in got], float)
    every = np.array([r.x for r in got]).reshape(len(got), len(ODDS), 2, N_STATES)
    w = np.where(y > 0, counts.get(1, 0) / max(1, y.sum()), counts.get(0, 0) / max(1, (1 - y).sum()))
    best = None
    for k, least in enumerate(ODDS):
        for combination in itertools.product(*FACTORS.values()):
            factors = state_factors(*combination)
            b, fitted = logistic(np.column_stack([every[:, k, 1] @ factors, np.log1p(every[:, k, 0] @ factors)]), y, w)
            if best is None or fitted > best[0] + 1e-9:  # the first wins ties: negated and reported clauses count for less
                best = fitted, (arcs, toxic, clean, tried, least), factors, b
    return best[1:]


def score(docs: DataFrame, model: tuple[tuple, np.ndarray, np.ndarray]) -> DataFrame:
    """docs (any columns, doc_id and text among them): their doc_id, score, predicted and n_clauses (matched)."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def scored(batches):
        made, factors, b = sent.value
        machine = Grammar(*made)
        for batch in batches:
            scores, matched = [], []
            for text in batch.column("text").to_pylist():
                clauses = machine.document(text) if text else None
                highest, total = features(clauses, factors)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, b[0] + b[1] * highest + b[2] * total)))))
                matched.append(0 if clauses is None else len(clauses))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(matched, pa.int64())], ["doc_id", "score", "predicted", "n_clauses"])

    return narrow(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(scored, "doc_id long, score double, predicted int, n_clauses long")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted, n_clauses. Labels of documents whose crc32(doc_id) mod folds is 0 are never
    learned from."""
    small_batches(docs.sparkSession)
    learned = labels.where(~held_out(labels["doc_id"], folds, lambda r: r == 0))
    model = fit(narrow(docs, "doc_id", "text"), learned)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id"), folds, lambda r: r == 0).alias("held_out"), "score", "predicted", "n_clauses")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (all columns) less those that score 0.5 or more; every label may be learned from."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(narrow(docs, "doc_id", "text"), labels))

    def clean(batches):
        made, factors, b = sent.value
        machine = Grammar(*made)
        for batch in batches:
            keep = []
            for text in batch.column("text").to_pylist():
                highest, total = features(machine.document(text) if text else None, factors)
                keep.append(b[0] + b[1] * highest + b[2] * total < 0)
            yield batch.filter(pa.array(keep, pa.bool_()))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(clean, docs.schema)
