"""Labels: phrases, term statistics, presentability, phrase graph, candidates and their fusion."""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from quirelight import contracts
from quirelight.functions import text as T
from quirelight.operators import evidence
from quirelight.operators import features as M
from quirelight.storage import stored

C = contracts.load("identity")
SPLIT = r"[.,;:!?()\[\]{}\"“”/\\|]+|\s+[-–—]\s+"
STRIP = r"^[\"'“”‘’()\[\]{}.,;:!?]+|[\"'“”‘’()\[\]{}.,;:!?]+$"
MAX_PHRASE_WORDS = 12
#: Rows of a batch of edges that a document hands on.
EDGE_ROWS = 1 << 16
MAX_CHAIN_WORDS = 16
#: Terms of a table that is sent whole to the words; a larger one is met by join.
SENT_TERMS = 1 << 17
SOURCES = tuple(C["fusion_weights"])
#: What an elected entry may hold.
ENTRY = {"text": "string", "score": "double", "tokens": "array<string>", "level": "string", "presentability": "double", "sources": "array<string>", "contributions": "array<struct<source:string,value:double,weight:double,contribution:double>>"}
#: Of a candidate's unit, what goes with the candidate.
PLACED = ("page", "y", "x", "page_height", "bold", "level", "first_page")


def phrase_runs(text: F.Column) -> F.Column:
    """chunk, island, part, words: a text's runs of words between punctuation and hard stopwords, of at most 12 words,
    without connectors at their edges. Runs are cut within the row, at line feeds put between words that have none, so
    that no word is ever shuffled or sorted."""
    filled = lambda words: F.filter(words, lambda x: x != "")
    bare = lambda c: filled(F.transform(F.split(F.trim(c), r"\s+"), lambda x: F.regexp_replace(x, STRIP, "")))
    at_hard = lambda c: F.array_join(F.transform(bare(c), lambda x: F.when(F.lower(x).isin(C["hard_stopwords"]), "\n").otherwise(x)), " ")
    at_most = lambda c: F.array_join(F.transform(filled(F.split(c, " ")), lambda x, i: F.when((i > 0) & (i % MAX_PHRASE_WORDS == 0), F.concat(F.lit("\n"), x)).otherwise(x)), " ")
    numbered = lambda parts, *names: F.transform(parts, lambda x, i: F.struct(*[x[n].alias(n) for n in names[:-1]], i.alias(names[-1]), x["c"].alias("c")))
    cut = lambda runs, by, *names: F.flatten(F.transform(runs, lambda r: numbered(F.transform(F.split(by(r["c"]), "\n"), lambda c: F.struct(*[r[n].alias(n) for n in names[:-1]], c.alias("c"))), *names)))
    chunks = numbered(F.transform(F.split(text, SPLIT), lambda c: F.struct(c.alias("c"))), "chunk")
    parts = cut(cut(chunks, at_hard, "chunk", "island"), at_most, "chunk", "island", "part")
    rows = F.transform(parts, lambda r: F.struct(r["chunk"].alias("chunk"), r["island"].cast("long").alias("island"), r["part"].alias("part"), filled(F.split(r["c"], " ")).alias("words")))
    inner = lambda words: F.transform(words, lambda x, i: F.when(~F.lower(x).isin(C["connectors"]), i))
    edged = F.transform(rows, lambda r: F.struct(r.alias("r"), F.array_min(inner(r["words"])).alias("lo"), F.array_max(inner(r["words"])).alias("hi")))
    some = F.filter(edged, lambda e: e["lo"].isNotNull())
    return F.transform(some, lambda e: F.struct(*[e["r"][c].alias(c) for c in ("chunk", "island", "part")], F.slice(e["r"]["words"], e["lo"] + 1, e["hi"] - e["lo"] + 1).alias("words")))


def phrases(texts: DataFrame) -> DataFrame:
    """texts: document_id, ord, text. document_id, ord and phrase_runs()."""
    return texts.select("document_id", "ord", F.inline(phrase_runs(F.col("text"))))


def rake_words(found: DataFrame) -> DataFrame:
    """document_id, word, freq, score: (degree + frequency) / frequency, of words of two characters or more."""
    own = F.filter(F.transform("words", lambda x: F.lower(x)), lambda x: F.length(x) >= 2)
    one = found.select("document_id", own.alias("own")).select("document_id", F.explode("own").alias("word"), F.size("own").alias("n"))
    counts = one.groupBy("document_id", "word").agg(F.count("*").alias("freq"), F.sum(F.col("n") - 1).alias("degree"))
    return counts.select("document_id", "word", "freq", ((F.col("degree") + F.col("freq")) / F.col("freq")).alias("score"))


def content_terms(text: F.Column) -> F.Column:
    """Words fit for retrieval that aren't stopwords."""
    return F.filter(T.lexical_tokens(text), lambda w: (F.length(w) >= 2) & ~w.rlike(r"^[0-9]+$") & ~w.isin(C["connectors"] + C["hard_stopwords"]))


def terms(texts: DataFrame) -> DataFrame:
    """document_id, term, tf, length."""
    counts = texts.select("document_id", F.explode(content_terms(F.col("text"))).alias("term")).groupBy("document_id", "term").agg(F.count("*").alias("tf"))
    return counts.withColumn("length", F.sum("tf").over(Window.partitionBy("document_id")))


def idf(corpus: DataFrame) -> DataFrame:
    """corpus: document_id, text. term, df, idf (smoothed, 6 places)."""
    n = corpus.agg(F.count_distinct("document_id").alias("n"))
    df = corpus.select("document_id", F.explode(F.array_distinct(content_terms(F.col("text")))).alias("term")).groupBy("term").agg(F.count_distinct("document_id").alias("df"))
    return df.crossJoin(F.broadcast(n)).select("term", "df", T.rounded(F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1), 6).alias("idf"))  # one row


def idf_summary(corpus: DataFrame, table: DataFrame) -> DataFrame:
    """One row: documents, avgdl (mean terms a document, one at least, 2 places), default_idf, most (the highest idf), and
    version (of the table's content)."""
    lengths = corpus.select("document_id", F.size(content_terms(F.col("text"))).alias("n")).groupBy("document_id").agg(F.greatest(F.sum("n"), F.lit(1)).alias("n"))
    sizes = lengths.agg(F.count("*").alias("documents"), T.rounded(F.avg("n"), 2).alias("avgdl"))
    content = table.agg(F.max("idf").alias("most"), F.sum(F.xxhash64("term", "idf").cast("decimal(38,0)")).alias("sum"))
    default = T.rounded(F.log((F.col("documents") + 0.5) / 0.5 + 1), 6)
    version = F.concat(F.lit("IDF-"), F.col("documents").cast("string"), F.lit("docs-"), F.substring(F.sha2(F.col("sum").cast("string"), 256), 1, 16))
    return sizes.crossJoin(content).select("documents", "avgdl", default.alias("default_idf"), "most", version.alias("version"))  # one row each


def freeze(corpus: DataFrame, folder: str) -> None:
    """Write the term table and its summary; thaw() reads them, so that labels don't change as a corpus grows."""
    table = idf(corpus)
    table.write.parquet(f"{folder}/terms")
    idf_summary(corpus, table.sparkSession.read.parquet(f"{folder}/terms")).coalesce(1).write.json(f"{folder}/summary")


def thaw(spark, folder: str | None) -> tuple[DataFrame, DataFrame]:
    """The frozen table and its summary; without a folder neutral ones, by which all terms are equally rare."""
    schema = "documents long, avgdl double, default_idf double, most double, version string"
    if folder is None:
        return spark.createDataFrame([], "term string, df long, idf double"), spark.createDataFrame([(0, None, 1.0, 1.0, "absent")], schema)
    return spark.read.parquet(f"{folder}/terms"), spark.read.schema(schema).json(f"{folder}/summary")


def bm25_words(texts: DataFrame, table: DataFrame, summary: DataFrame) -> DataFrame:
    """document_id, word, score: a term's part of a phrase's BM25; terms that the table lacks count as the rarest. Without
    a frozen mean length a document's own stands for it."""
    k1, b = C["bm25"]["k1"], C["bm25"]["b"]
    rows = terms(texts).join(table.select("term", "idf"), "term", "left").crossJoin(F.broadcast(summary.select("avgdl", "most")))  # one row
    weight = F.coalesce("idf", "most", F.lit(1.0))
    length = F.col("length") / F.coalesce("avgdl", F.col("length").cast("double"))
    return rows.select("document_id", F.col("term").alias("word"), (weight * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * length))).alias("score"))


class Words(NamedTuple):
    """What a document's candidates meet: docs has a row a document with its texts, and with bm25 (its words' scores: word,
    score) where idf is None; else idf has the term table, and avgdl and most are its summary's."""

    docs: DataFrame
    idf: dict[str, float] | None
    avgdl: float | None
    most: float | None


def word_scores(texts: DataFrame, table: DataFrame, summary: DataFrame) -> Words:
    """A document's texts, which meet once and are cut into words where its candidates are, so that no word is ever a row.
    Only a term table of over SENT_TERMS is met by its words as rows."""
    texts = texts.select("document_id", "text").repartition("document_id")
    docs = texts.groupBy("document_id").agg(F.collect_list("text").alias("texts"))
    known = table.select("term", "idf").limit(SENT_TERMS + 1).collect()
    if len(known) > SENT_TERMS:
        listed = bm25_words(texts, table, summary).groupBy(F.col("document_id").alias("b_d")).agg(F.collect_list(F.struct("word", "score")).alias("bm25"))
        return Words(docs.join(listed, F.col("document_id") == F.col("b_d"), "left").drop("b_d"), None, None, None)
    one = summary.select(F.col("avgdl").cast("double"), F.col("most").cast("double")).head()
    return Words(docs, {r.term: r.idf for r in known if r.idf is not None}, one.avgdl, one.most)


TERM_SOURCES = ("rake", "bm25", "textrank")
HARD, CONNECTORS = frozenset(C["hard_stopwords"]), frozenset(C["connectors"])
STOP, UNEVALUATED = frozenset(C["connectors"] + C["hard_stopwords"]), frozenset(C["evaluation_stopwords"])


@lru_cache(1 << 16)
def counted(word: str) -> tuple[bool, bool, bool]:
    """Whether each of TERM_SOURCES counts a word of a candidate; a score's divisor is the root of how many it counts."""
    plain, size = re.fullmatch("[0-9]+", word) is None, len(word)
    return size >= 2 and word not in HARD, plain and size >= 2 and word not in STOP, plain and size > 2 and word not in STOP


def _key_scores(keys: list[str], found: tuple[dict, dict, dict]) -> list[list[float]]:
    """For each of TERM_SOURCES and each key the sum of the scores of the words it counts, in order, over the root of
    their number."""
    counts, out = {}, [[], [], []]
    for key in keys:
        words = key.split(" ")
        for w in words:
            if w not in counts:
                counts[w] = counted(w)
        for i, (scores, values) in enumerate(zip(found, out, strict=True)):
            total, n = 0.0, 0
            for w in words:
                if counts[w][i]:
                    total, n = total + scores.get(w, 0.0), n + 1
            values.append(total / n**0.5 if n else 0.0)
    return out


LEXICAL, BREAKS, SPACES = re.compile(r"[A-Za-z][A-Za-z'’\-]*|[0-9]+[A-Za-z]*"), re.compile(SPLIT, re.ASCII), re.compile(r"\s+", re.ASCII)
EDGES, ENDINGS = "\"'“”‘’()[]{}.,;:!?", "\u0085\u2028\u2029"


def _stripped(word: str) -> str:
    """A word without STRIP, of whose ends the second may also be before a line's end."""
    word = word.strip(EDGES)
    return word[:-1].rstrip(EDGES) + word[-1] if word and word[-1] in ENDINGS else word


def lower_phrases(text: str) -> list[list[str]]:
    """The words of phrase_runs(), in lower case. BREAKS take all of EDGES but three quotes, so words are stripped only
    where one of these or a line's end is in the text."""
    if plain := text.isascii():
        text = text.lower()
    edged, spaced = not plain or "'" in text, re.search(r"[\t-\r]", text)
    out = []
    for chunk in BREAKS.split(text):
        words = SPACES.split(chunk.strip(" ")) if spaced else chunk.split(" ")
        if edged:
            words = [_stripped(w).lower() for w in words]
        island = []
        for word in [*words, None]:
            if word and word not in HARD:
                island.append(word)
            elif island and word != "":
                for i in range(0, len(island), MAX_PHRASE_WORDS):
                    part = island[i : i + MAX_PHRASE_WORDS]
                    at = [k for k, w in enumerate(part) if w not in CONNECTORS]
                    if at:
                        out.append(part[at[0] : at[-1] + 1])
                island = []
    return out


def _rake(texts: list[str]) -> dict[str, float]:
    """rake_words() of one document, whose phrases are counted by their number of words."""
    by_size: dict[int, list[str]] = {}
    for text in texts:
        for words in lower_phrases(text):
            own = [w for w in words if len(w) >= 2]
            by_size.setdefault(len(own), []).extend(own)
    freq, degree = Counter(), Counter()
    for size, words in by_size.items():
        for w, n in Counter(words).items():
            freq[w] += n
            degree[w] += n * (size - 1)
    return {w: (degree[w] + n) / n for w, n in freq.items()}


def _bm25(counts: Counter, words: tuple[dict, float | None, float | None]) -> dict[str, float]:
    """bm25_words() of one document, of the numbers of its lexical tokens."""
    idf, avgdl, most = words
    k1, b = C["bm25"]["k1"], C["bm25"]["b"]
    tf = {w: n for w, n in counts.items() if counted(w)[1]}
    size = sum(tf.values())
    length = size / (float(size) if avgdl is None else avgdl) if size else 0.0
    rarest = 1.0 if most is None else most
    return {w: idf.get(w, rarest) * n * (k1 + 1) / (n + k1 * (1 - b + b * length)) for w, n in tf.items()}


def _tokens(text: str) -> list[str]:
    """T.lexical_tokens() of one text."""
    return LEXICAL.findall(text.lower()) if text.isascii() else [w.lower() for w in LEXICAL.findall(text)]


def _words_of(texts: list[str], bm25: dict | None, words: tuple) -> tuple[dict, dict, dict]:
    """For each of TERM_SOURCES the scores of a document's words; bm25 if they are known."""
    runs = [_tokens(text) for text in texts]
    counts = Counter(w for run in runs for w in run)
    fit = {w for w in counts if counted(w)[2]}
    graph = [run for run in ([w for w in run if w in fit] for run in runs) if run]
    ranked = {}
    if graph:
        names, a, b = _graph(graph)
        ranked = dict(zip(names, _ranks(names, a, b)["score"].tolist(), strict=True))
    return _rake(texts), _bm25(counts, words) if bm25 is None else bm25, ranked


def phrase_scores(found: DataFrame, words: Words) -> DataFrame:
    """Adds rake, bm25 and textrank to candidates (document_id, key), each scaled within its document. A document's
    candidates meet its texts (word_scores()) in one row, where the texts are cut and scored, so no word is ever paired with
    the text it stands in: what is shuffled is each candidate once, and each text."""
    own = found.groupBy("document_id").agg(F.collect_list(F.struct(*[c for c in found.columns if c != "document_id"])).alias("found"))
    docs = own.join(words.docs.withColumnRenamed("document_id", "w_d"), F.col("document_id") == F.col("w_d"), "left").drop("w_d")
    docs = docs.withColumn("keys", F.col("found").getField("key"))
    schema = StructType([docs.schema["document_id"], docs.schema["found"], *[StructField(c, ArrayType(DoubleType())) for c in TERM_SOURCES]])
    joined, sent = words.idf is None, (words.idf, words.avgdl, words.most)

    def items(at) -> dict:
        return dict(zip(at.values.field("word").to_pylist(), at.values.field("score").to_pylist(), strict=True)) if at.is_valid else {}

    def each(batches):
        for batch in batches:
            scores = []
            for i in range(batch.num_rows):
                bm25 = items(batch.column("bm25")[i]) if joined else None
                scores.append(_key_scores(batch.column("keys")[i].as_py(), _words_of(batch.column("texts")[i].as_py() or [], bm25, sent)))
            columns = [pa.array([s[k] for s in scores], pa.list_(pa.float64())) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("document_id"), batch.column("found"), *columns], names=schema.names)

    docs = docs.mapInArrow(each, schema)
    share = lambda c: lambda v: F.when(F.col(f"{c}_hi") - F.col(f"{c}_lo") < 1e-9, 0.5).otherwise((v - F.col(f"{c}_lo")) / (F.col(f"{c}_hi") - F.col(f"{c}_lo")))
    for c in TERM_SOURCES:
        docs = docs.withColumn(c, F.transform(c, lambda v: T.rounded(v, 4)))
        docs = docs.withColumns({f"{c}_lo": F.array_min(c), f"{c}_hi": F.array_max(c)})
    docs = docs.withColumns({c: F.transform(c, share(c)) for c in TERM_SOURCES})
    rows = docs.select("document_id", F.explode(F.arrays_zip("found", *TERM_SOURCES)).alias("e"))
    return rows.select("document_id", "e.found.*", *[f"e.{c}" for c in TERM_SOURCES])


def content_runs(texts: DataFrame) -> DataFrame:
    """document_id, runs: a row a document, of each of its texts the content words in order."""
    stop = C["connectors"] + C["hard_stopwords"]
    content = F.filter(T.lexical_tokens(F.col("text")), lambda w: (F.length(w) > 2) & ~w.rlike("^[0-9]+$") & ~w.isin(stop))
    return texts.select("document_id", content.alias("w")).groupBy("document_id").agg(F.collect_list("w").alias("runs"))


def _graph(runs: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """A document's words in order, and the numbers of those within three of each other in one run, both ways, each pair
    once and in order; a word with itself is left out."""
    words = sorted({w for run in runs for w in run})
    number = {w: i for i, w in enumerate(words)}
    at = np.array([number[w] for run in runs for w in run], np.int64)
    of_run = np.repeat(np.arange(len(runs)), [len(run) for run in runs])
    near = [(at[:-n], at[n:], of_run[:-n] == of_run[n:]) for n in (1, 2)]
    a, b = (np.concatenate([p[i][p[2]] for p in near]) for i in (0, 1))
    key = np.unique(np.concatenate([a * len(words) + b, b * len(words) + a])[np.tile(a != b, 2)])
    return words, *np.divmod(key, max(1, len(words)))


def _by_document(rows: DataFrame, of, schema: str) -> DataFrame:
    """rows: document_id, runs. of(words, a, b) gives a document's columns after document_id; batches are of at most
    EDGE_ROWS rows."""

    def each(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                runs = [run for run in batch.column("runs")[i].as_py() if run]
                if runs:
                    table = pa.table(of(*_graph(runs)))
                    table = table.add_column(0, "document_id", pa.repeat(batch.column("document_id")[i], len(table)))
                    yield from table.to_batches(max_chunksize=EDGE_ROWS)

    return rows.mapInArrow(each, schema)


def word_edges(texts: DataFrame) -> DataFrame:
    """document_id, a, b: content words within three of each other in one text, both ways; a word that stands alone has
    itself for b. A document's words meet in one task, as for its ranks, and only they are shuffled."""

    def edges(words, a, b):
        names, own = pa.array(words, pa.string()), np.arange(len(words))
        return {"a": names.take(pa.array(np.concatenate([a, own]))), "b": names.take(pa.array(np.concatenate([b, own])))}

    return _by_document(content_runs(texts), edges, "document_id string, a string, b string")


def _ranks(words: list[str], a: np.ndarray, b: np.ndarray) -> dict:
    d, rounds = C["textrank"]["damping"], C["textrank"]["iterations"]
    degree = np.maximum(1, np.bincount(a, minlength=len(words)))
    score = np.full(len(words), 1 / len(words))
    for _ in range(rounds):
        score = (1 - d) / len(words) + d * np.bincount(a, (score / degree)[b], len(words))
    return {"word": pa.array(words, pa.string()), "score": score / score.max()}


def textrank(texts: DataFrame) -> DataFrame:
    """document_id, word, score: PageRank over one document's words, a fixed number of rounds, the highest scaled to 1. A
    document's graph (word_edges()) is what one task holds, and never leaves it; its neighbours are summed in order of
    words. A word without neighbours is ranked too."""
    return _by_document(content_runs(texts), _ranks, "document_id string, word string, score double")


def presentability(df: DataFrame, column: str = "text") -> DataFrame:
    """Adds presentability, how well a text would sit on a tab, and rules: what was added or taken off, in order."""
    P = C["presentability"]
    made = {}

    def once(name: str, value: F.Column) -> F.Column:
        """A column of its own, made once a row however many rules read it."""
        nonlocal df
        made[name] = f"pr_{name}"
        df = df.withColumn(made[name], value)
        return F.col(made[name])

    t = once("text", T.stripped(F.col(column)))
    w = once("words", F.filter(F.split(t, r"\s+"), lambda x: x != ""))
    n, chars = once("n", F.size(w)), once("chars", F.length(t))
    edge = lambda k: F.regexp_replace(F.lower(F.try_element_at(w, F.lit(k))), r"^[.,;:]+|[.,;:]+$", "")
    first, last = once("first", edge(1)), once("last", edge(-1))
    stopwords = C["connectors"] + C["hard_stopwords"]
    over = lambda x, most: 0.5 + 0.5 * F.least((x - most) / most, F.lit(2.0))
    long_words, long_chars = F.when(n > 18, P["too_many_words"] * over(n, 18)), F.when(chars > 95, P["over_max_chars"] * over(chars, 95))
    by_words = F.coalesce(long_words <= long_chars, n > 18)
    tokens = once("tokens", T.lexical_tokens(t))
    stop_ratio = F.when(F.size(tokens) > 0, F.size(F.filter(tokens, lambda x: x.isin(stopwords))) / F.size(tokens)).otherwise(1.0)
    letters, uppers = once("letters", F.length(F.regexp_replace(t, r"[^\p{L}]+", ""))), once("uppers", F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")))
    solid, digits = once("solid", F.length(F.regexp_replace(t, r"\s+", ""))), once("digits", F.length(F.regexp_replace(t, r"[^0-9]+", "")))
    content = once("content", F.filter(w, lambda x: x.rlike(r"^\p{L}") & ~F.lower(x).isin(stopwords)))
    title_case = (F.size(content) >= 2) & (F.size(F.filter(content, lambda x: x.rlike(r"^\p{Lu}"))) / F.size(content) >= 0.75)
    unbalanced = F.lit(False)
    for a, b in ("()", "[]", "{}"):
        count = lambda s: chars - F.length(F.replace(t, F.lit(s), F.lit("")))
        unbalanced |= count(a) != count(b)
    capitals = (letters > 0) & (uppers / letters > 0.85)
    long = (n > 18) | (chars > 95)
    rule = lambda name, condition, delta=None: F.when(condition, F.struct(F.lit(name).alias("rule"), (F.lit(P[name]) if delta is None else delta).cast("double").alias("delta")))
    fired = F.array(
        rule("too_many_words", long & by_words, long_words),
        rule("over_max_chars", long & ~by_words, long_chars),
        rule("ideal_length", ~long & n.between(3, 12)),
        rule("too_few_words", ~long & (n < 2)),
        rule("short_of_ideal", ~long & (n == 2)),
        rule("ends_with_connector", last.isin(C["connectors"])),
        rule("starts_with_connector", first.isin(C["connectors"]) & ~first.isin("a", "an", "the")),
        rule("sentence_punctuation", t.rlike(r"[.!?]\s+[A-Za-z]")),
        rule("trailing_punctuation", t.rlike(r"[,;:\-–—/]\s*$")),
        rule("repeated_whitespace_artifact", t.rlike(r"\s{3,}") | t.rlike(r"(.)\1{4,}")),
        rule("unbalanced_brackets", unbalanced),
        rule("high_stopword_ratio", stop_ratio > 0.55),
        rule("digit_heavy", (solid > 0) & (digits / solid > 0.30)),
        rule("furniture_word", F.arrays_overlap(tokens, T.word_array("furniture"))),
        rule("caps_heading", capitals & (n <= 12)),
        rule("all_caps_verbose", capitals & (n > 12)),
        rule("title_case_consistent", (letters > 0) & ~capitals & title_case),
        rule("compact", (chars <= 60) & n.between(3, 12)),
    )
    empty = F.array(F.struct(F.lit("empty").alias("rule"), F.lit(-1.0).alias("delta")))
    df = df.withColumn("rules", F.when(t == "", empty).otherwise(F.filter(fired, lambda x: x.isNotNull())))
    total = F.aggregate("rules", F.lit(float(P["neutral"])), lambda a, x: a + x["delta"])
    return df.withColumn("presentability", F.when(t == "", 0.0).otherwise(T.rounded(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)), 4))).drop(*made.values())


def _reading():
    """A document's units in reading order."""
    return Window.partitionBy("document_id").orderBy("page", "y", "x", "ord")


def _linked(units: DataFrame) -> DataFrame:
    """units with links: ord and text of each of the next three that may be part of one heading with it, else null. Gaps are
    from a unit's bottom to the next one's top; their median over the whole document is the budget's measure."""
    page = Window.partitionBy("document_id", "page").orderBy("y", "x", "ord")
    down = F.lead("y").over(page) - F.col("y") - F.col("height")
    rows = units.withColumn("down", down).withColumn("gap", F.coalesce(F.median(F.when(F.col("down") > 0, F.col("down"))).over(Window.partitionBy("document_id")), F.lit(12.0)))
    rows = rows.withColumn("next", F.array(*[F.lead(F.struct("page", "ord", "x", "y", "width", "height", "font_size", "bold", "text"), k).over(_reading()) for k in (1, 2, 3)]))
    a = F.col
    weight = lambda bold: F.coalesce(bold, F.lit(False))

    def link(b: F.Column) -> F.Column:
        below = b["y"] - (a("y") + a("height"))
        aligned = (F.abs(a("x") - b["x"]) <= 4) | (F.abs(a("x") + a("width") / 2 - b["x"] - b["width"] / 2) <= 12)
        good = below.between(-1.0, F.lit(2.2) * F.greatest(a("gap"), F.lit(1.0))) & (F.abs(a("font_size") - b["font_size"]) <= 0.6) & (weight(a("bold")) == weight(b["bold"])) & aligned
        return F.when((a("page") == b["page"]) & good, F.struct(b["ord"].alias("ord"), b["text"].alias("text")))

    return rows.withColumn("links", F.transform("next", link)).drop("down", "gap", "next")


def phrase_edges(units: DataFrame) -> DataFrame:
    """document_id, page, a, b (ord): units that may be parts of one heading, among the next three."""
    return _linked(units).select("document_id", "page", F.col("ord").alias("a"), F.explode(F.array_compact("links")).alias("b")).select("document_id", "page", "a", F.col("b.ord").alias("b"))


def chained(units: DataFrame) -> DataFrame:
    """units with chains (text, ords): two or three linked units, this one first, joined by " - ", of at most 16 words. Two
    that are longer are in no chain of three either. Links are read from the rows that follow, so no unit is joined."""
    joined = lambda *parts: F.concat_ws(" - ", *parts)
    short = lambda text: F.size(F.split(text, " ")) <= MAX_CHAIN_WORDS
    rows = _linked(units).withColumn("links", F.transform("links", lambda b: F.when(b.isNotNull() & short(joined(F.col("text"), b["text"])), b)))
    rows = rows.withColumn("after", F.array(*[F.coalesce(F.lead("links", k).over(_reading()), F.slice("links", 1, 0)) for k in (1, 2, 3)]))

    def of(z: F.Column) -> F.Column:
        b = z["links"]
        two = F.struct(joined(F.col("text"), b["text"]).alias("text"), F.array(F.col("ord"), b["ord"]).alias("ords"))
        three = F.transform(F.array_compact(z["after"]), lambda c: F.struct(joined(F.col("text"), b["text"], c["text"]).alias("text"), F.array(F.col("ord"), b["ord"], c["ord"]).alias("ords")))
        return F.concat(F.array(two), F.filter(three, lambda c: short(c["text"])))

    found = F.flatten(F.transform(F.filter(F.arrays_zip("links", "after"), lambda z: z["links"].isNotNull()), of))
    return rows.withColumn("chains", found).drop("links", "after")


def chains(units: DataFrame) -> DataFrame:
    """document_id, text, ords of chained()."""
    return chained(units).select("document_id", F.inline("chains"))


def clean(text: F.Column) -> F.Column:
    return F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), r"^[ \t\-–—·|]+", ""), r"[ \t\-–—·|]+$", "")


def candidates(units: DataFrame) -> DataFrame:
    """document_id, key, text, sources, ord and its unit's geometry: whole units, their phrases where a unit is short
    or a heading, and chains. Of equal keys the first generator's first stands, with all generators' names."""
    units = units.repartition("document_id")  # all that follows is by document
    level = M.levels(units).groupBy(F.col("document_id").alias("l_d")).agg(F.collect_list(F.struct("size", "level")).alias("levels"))
    own = F.get(F.filter("levels", lambda e: e["size"] == F.rint(F.col("font_size") * 2) / 2), 0)["level"]
    sized = units.join(level, F.col("document_id") == F.col("l_d"), "left").withColumn("level", own).withColumn("first_page", F.min_by("page", "ord").over(Window.partitionBy("document_id"))).drop("l_d", "levels")
    gated = F.col("level").isNotNull() & (F.col("level").startswith("h") | (F.size(F.split("text", " ")) <= 16))
    rows = chained(sized).withColumn("runs", F.when(gated, phrase_runs(F.col("text"))))
    made = lambda g, k, text, source: F.struct(F.lit(g).alias("g"), k.alias("k"), clean(text).alias("text"), F.lit(source).alias("source"))
    whole = F.array(made(0, F.lit(0), F.col("text"), "unit"))
    parts = F.filter(F.transform("runs", lambda r, i: F.struct(i.alias("i"), r["words"].alias("words"))), lambda r: F.size(r["words"]) >= 2)
    sub = F.when(F.size("runs") >= 2, F.transform(parts, lambda r: made(1, r["i"] + 1, F.array_join(r["words"], " "), "subphrase")))
    composed = F.transform("chains", lambda c: made(2, F.coalesce(F.get(c["ords"], 1), F.lit(0)), c["text"], "composed"))
    every = F.concat(whole, F.coalesce(sub, F.slice(whole, 1, 0)), composed)
    every = rows.select("document_id", "ord", F.struct(*PLACED).alias("unit"), F.inline(every)).where(F.length("text") >= C["candidate_min_chars"]).withColumn("key", F.array_join(T.lexical_tokens(F.col("text")), " ")).where("key <> ''")
    first = F.min(F.struct("g", "ord", "k", "text", "unit"))  # of equal ord the unit is the same
    out = every.groupBy("document_id", "key").agg(first.alias("f"), F.sort_array(F.collect_set("source")).alias("sources"))
    return out.where("document_id is not null and f.ord is not null and f.unit.level is not null").select("document_id", "key", F.col("f.text").alias("text"), "sources", F.col("f.ord").alias("ord"), "f.unit.*")


def fused(units: DataFrame, table: DataFrame, summary: DataFrame) -> DataFrame:
    """candidates() with seven sources (term scores scaled within a document) and a score for them all. Units are written
    once, as many steps read them."""
    units = stored(units, "identity-units")
    rows = phrase_scores(candidates(units), word_scores(units, table, summary))
    rows = presentability(rows)
    level = F.lit(C["level_scores"]["body"])
    for name, value in C["level_scores"].items():
        level = F.when(F.col("level") == name, value).otherwise(level)
    promoted = F.coalesce("bold", F.lit(False)) & F.col("level").isin("body", "h3", "h4")
    level = F.when(promoted, F.least(F.lit(C["level_scores"]["h2"]), level + C["bold_promotion"])).otherwise(level)
    place = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("y") / F.coalesce(F.nullif("page_height", F.lit(0.0)), F.lit(792.0))))
    rows = rows.withColumn("typography", T.rounded(level, 4)).withColumn("position", T.rounded(1 - place, 4)).withColumn("graph_bonus", F.array_contains("sources", "composed").cast("double"))
    furniture = F.arrays_overlap(T.lexical_tokens(F.col("text")), T.word_array("furniture"))
    rows = rows.withColumn("furniture", furniture).withColumn("noise", F.col("level") == "outlier").withColumn("not_first_page", F.col("page") > F.col("first_page")).drop("first_page")
    rows = evidence.added(rows, units)
    return rows.withColumn("score", total(sources())).withColumn("contributions", contributions())


def sources() -> tuple[str, ...]:
    """The contract's sources and those that are registered beside them."""
    return (*SOURCES, *evidence.weights())


def source_weights() -> dict[str, float]:
    return evidence.weights() | C["fusion_weights"]


def contributions() -> F.Column:
    """What each source and penalty gives to the score."""
    parts = [F.struct(F.lit(n).alias("source"), T.rounded(F.col(n), 4).alias("value"), F.lit(float(w)).alias("weight"), T.rounded(F.col(n) * w, 4).alias("contribution")) for n, w in ((n, source_weights()[n]) for n in sources())]
    parts += [F.when(F.col(n), F.struct(F.lit(n).alias("source"), F.lit(1.0).alias("value"), F.lit(float(w)).alias("weight"), F.lit(float(w)).alias("contribution"))) for n, w in C["fusion_penalties"].items()]
    return F.filter(F.array(*parts), lambda x: x.isNotNull())


def total(enabled) -> F.Column:
    """The sum of enabled sources by weight, each rounded, and penalties, which always apply."""
    out = F.lit(0.0)
    for name in sources():
        if name in enabled:
            out = out + T.rounded(F.col(name) * source_weights()[name], 4)
    for name, value in C["fusion_penalties"].items():
        out = out + F.when(F.col(name), value).otherwise(0.0)
    return T.rounded(out, 4)


def content_words(key: F.Column) -> F.Column:
    stop = T.word_array("connectors", "hard_stopwords")
    return F.array_distinct(F.filter(F.split(key, " "), lambda w: ~F.array_contains(stop, w)))


def elected(scores: DataFrame, n: int = 3) -> DataFrame:
    """A row a document: document_id, candidates (their number), best (the n best, each unlike those before it: text,
    score, level, presentability, sources, contributions), suppressed (up to ten duplicates met before the n were
    complete: text, score, duplicate_of), margin and confidence. One fold over a document's candidates in order, which
    adds to two short arrays only."""
    names = ("text", "score", "tokens", "level", "presentability", "sources", "contributions")
    one = F.struct((-F.col("score")).alias("o"), "page", "y", "x", "key", "text", "score", content_words(F.col("key")).alias("tokens"), *names[3:])
    return _elected(scores.groupBy("document_id").agg(F.sort_array(F.collect_list(one)).alias("s")), n, names)


def _elected(docs: DataFrame, n: int, names: tuple[str, ...]) -> DataFrame:
    """elected() of rows (s: candidates in order, and others that are kept), with names for the columns of best."""
    best_kind = f"array<struct<{','.join(f'{c}:{ENTRY[c]}' for c in names)}>>"
    gone_kind = "array<struct<text:string,score:double,duplicate_of:string>>"
    start = F.struct(F.array().cast(best_kind).alias("best"), F.array().cast(gone_kind).alias("suppressed"))

    def step(state, s):
        shared = lambda e: F.coalesce(F.size(F.array_intersect(e["tokens"], s["tokens"])) / F.nullif(F.least(F.size(e["tokens"]), F.size(s["tokens"])), F.lit(0)), F.lit(0.0)) >= C["duplicate_overlap"]
        like = F.get(F.filter(state["best"], shared), 0)
        entry = F.array(F.struct(*[s[c].alias(c) for c in names])).cast(best_kind)
        duplicate = F.array(F.struct(s["text"].alias("text"), s["score"].alias("score"), like["text"].alias("duplicate_of"))).cast(gone_kind)
        grown = F.struct(F.concat(state["best"], entry).alias("best"), state["suppressed"].alias("suppressed"))
        noted = F.struct(state["best"].alias("best"), F.when(F.size(state["suppressed"]) < 10, F.concat(state["suppressed"], duplicate)).otherwise(state["suppressed"]).alias("suppressed"))
        return F.when(F.size(state["best"]) >= n, state).when(like.isNotNull(), noted).otherwise(grown)

    kept = [c for c in docs.columns if c != "s"]
    out = docs.select(*kept, F.size("s").cast("long").alias("candidates"), F.aggregate("s", start, step).alias("e")).select(*kept, "candidates", "e.*")
    first, second = F.get("best", 0), F.get("best", 1)
    out = out.withColumn("margin", T.rounded(F.coalesce(first["score"] - second["score"], first["score"]), 4))
    return out.withColumn("confidence", F.when(F.col("margin") >= C["auto_margin"], "auto").when(F.col("margin") >= C["review_margin"], "review").otherwise("escalate"))


def labels(scores: DataFrame, n: int = 3) -> DataFrame:
    """document_id, rank, text, score, presentability of elected()'s best."""
    best = elected(scores, n).select("document_id", F.posexplode("best").alias("i", "e"))
    return best.select("document_id", (F.col("i") + 1).alias("rank"), F.col("e.text").alias("text"), F.col("e.score").alias("score"), F.col("e.presentability").alias("presentability"))


def evaluated(text: str) -> frozenset[str]:
    """T.evaluation_tokens() of one text."""
    return frozenset(w for w in re.findall("[a-z0-9]+", text.lower()) if len(w) > 1) - UNEVALUATED


def _matches(text: str, titles: list[frozenset[str]]) -> bool:
    """Whether a text's M.token_f1() with any title is 0.7 or more."""
    own = evaluated(text)
    return any(own & t and 2.0 * len(own & t) / (len(own) + len(t)) >= 0.7 for t in titles)


def _hits(texts: list[str], keys: list[str], scores: np.ndarray, titles: list[str], n: int) -> np.ndarray:
    """For each column of scores (a row a candidate, in the order that decides between equal ones) whether the first of
    the n best that are each unlike those before matches a title, and whether any does."""
    words = [frozenset(key.split(" ")) - STOP for key in keys]
    titles, known = [evaluated(t) for t in titles], {}
    out = np.zeros((2, scores.shape[1]), np.int64)
    for mask, order in enumerate(np.argsort(-scores, axis=0, kind="stable").T.tolist()):
        best = []
        for i in order:
            if not any(words[i] and words[k] and len(words[i] & words[k]) / min(len(words[i]), len(words[k])) >= C["duplicate_overlap"] for k in best):
                best.append(i)
                if len(best) == n:
                    break
        for i in best:
            if i not in known:
                known[i] = _matches(texts[i], titles)
        out[:, mask] = known[best[0]], any(known[i] for i in best)
    return out


def ablation(scores: DataFrame, truth: DataFrame, n: int = 3) -> DataFrame:
    """disabled, documents, top1, top3, delta_top1, delta_top3, verdict: the shares of documents whose first label, or any
    of n, matches the title (token F1 of 0.7 or more) with each source off. A candidate is shuffled once, with its score
    under every mask; a document's are then elected mask by mask where they met, and only counts leave the task."""
    masks = (None, *sources())
    masked = F.array(*[total([s for s in sources() if s != m]) for m in masks]).alias("masked")
    docs = scores.groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct("page", "y", "x", "key", "text", masked))).alias("found"))
    titles = truth.groupBy(F.col("document_id").alias("t_d")).agg(F.collect_list("title").alias("titles"))
    docs = docs.join(titles, F.col("document_id") == F.col("t_d")).select("titles", *[F.col("found").getField(c).alias(f"{c}s") for c in ("text", "key")], F.flatten(F.col("found").getField("masked")).alias("masked"))

    def each(batches):
        for batch in batches:
            out = np.zeros((2, len(masks)), np.int64)
            for i in range(batch.num_rows):
                titles, texts, keys = (batch.column(c)[i].as_py() for c in ("titles", "texts", "keys"))
                values = batch.column("masked")[i].values.fill_null(np.inf).to_numpy(zero_copy_only=False)  # null is first in Spark's order
                out += _hits(texts, keys, values.reshape(len(keys), len(masks)), titles, n)
            yield pa.RecordBatch.from_pydict({"documents": [batch.num_rows], "first": [out[0].tolist()], "any": [out[1].tolist()]})

    sums = docs.mapInArrow(each, "documents long, first array<long>, any array<long>")
    one = sums.agg(F.sum("documents").alias("documents"), *[F.sum(F.get(c, F.lit(i))).alias(f"{c}{i}") for c in ("first", "any") for i in range(len(masks))]).where("documents > 0")
    share = lambda c: T.rounded(F.col(c) / F.col("documents"), 4)
    gap = lambda c, i: T.rounded(share(f"{c}{i}") - share(f"{c}0"), 4)
    rows = [F.struct(F.lit(m or "none").alias("disabled"), "documents", share(f"first{i}").alias("top1"), share(f"any{i}").alias("top3"), gap("first", i).alias("delta_top1"), gap("any", i).alias("delta_top3")) for i, m in enumerate(masks)]
    out = one.select(F.inline(F.array(*rows)))
    verdict = F.when(F.col("delta_top1") <= -0.02, "load-bearing").when(F.col("delta_top1") >= 0.02, "HARMFUL - drop or re-weight").otherwise("no measurable effect")
    return out.select("disabled", "documents", "top1", "top3", "delta_top1", "delta_top3", verdict.alias("verdict"))
