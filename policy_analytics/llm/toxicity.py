"""Operator 4: toxicity by Levenshtein automata over a learned lexicon, read in context.

The lexicon is learned from labelled documents: words, and stems of productive prefixes,
that are far commoner in toxic than in clean texts. It is held as a trie; the Levenshtein
automata of its terms are run over the trie together and determinised while texts are
read, so a token is judged in one walk and misspelled terms are found. Every hit is scored
in a window of words around it, where quotation marks and words of reporting speak against
abuse and an addressed reader speaks for it. A logistic model of these scores gives the
score of the document.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, saved, seeded, sift, table

TOKEN = re.compile(r"\w+")
STEMS = (4, 5, 6)            # lengths of stems
LEAST_DOCS = 3               # toxic documents that a term must occur in
LEAST_WORDS = 5              # different words that make a stem productive
LEAST_ODDS = 4.0             # log odds ratio of a term, toxic against clean documents
SURE_ODDS = 2.0              # its lower bound (95 %)
PART_TERMS = 2_000           # terms in one automaton; a larger lexicon is read by several
MAX_FIT_ROWS = 20_000        # labelled rows on which the few weights of the model are fitted
MEMO_TOKENS = 1 << 16        # judged or counted tokens that a task holds; bounds memory, never results
BATCH = 2048                 # rows that a Python worker gets at once
BATCH_BYTES = 2 << 20        # and about their bytes; both bound memory, never results
WINDOW = 8                   # words before and after a hit
BITMAP_BYTES = 4096          # of Spark's bitmaps
MAX_LABEL_BYTES = 64 << 20   # of label bitmaps that are broadcast
MAX_STATES = 50_000          # cached automaton states per task, over all automata; beyond, a cache starts anew
LEAST_STATES = 2_000         # of one automaton
# Marks of quotation, words that report speech, words that address the reader.
QUOTES = "\"“”„«»‟″"
REPORTING = frozenset("said says say wrote writes quoted quote called calls claimed reported according "
                      "sagte sagt schrieb zitat nannte laut dit disait écrit citation appelé selon "
                      "dijo dice escribió cita llamó según".split())
ADDRESS = frozenset("you your yours u ur du dich dein deine ihr euch tu te toi vous ton votre tú usted vosotros eres".split())


def allowed(term: str) -> int:
    """Edits a term forgives: none up to 3 letters, one up to 8, two beyond."""
    return 0 if len(term) <= 3 else 1 if len(term) <= 8 else 2


def _hash(token: str) -> int:
    """A signed 64-bit hash."""
    return xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass")) - (1 << 63)


class Automaton:
    """The Levenshtein automata of all terms, intersected with their trie.

    A state is a set of (trie node, edits so far), the fewest edits per node. Transitions
    are computed once per state and character and cached.
    """

    def __init__(self, terms: list[str], most_states: int = MAX_STATES):
        self.most_states = most_states
        self.children: list[dict[str, int]] = [{}]
        self.term: list[int] = [-1]
        self.most = [0]
        self.terms = terms
        for i, t in enumerate(terms):
            node, path = 0, [0]
            for c in t:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(-1)
                    self.most.append(0)
                node = self.children[node][c]
                path.append(node)
            self.term[node] = i
            for n in path:
                self.most[n] = max(self.most[n], allowed(t))
        self._reset()

    def _reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: list[dict[str, int]] = []
        self.accept: list[tuple[int, int] | None] = []
        self.start = self._state(self._closed({0: 0}))

    def _closed(self, at: dict[int, int]) -> dict[int, int]:
        """With skipped trie characters (deletions)."""
        todo = list(at.items())
        while todo:
            node, e = todo.pop()
            for child in self.children[node].values():
                if e < self.most[child] and e + 1 < at.get(child, 99):
                    at[child] = e + 1
                    todo.append((child, e + 1))
        return at

    def _state(self, at: dict[int, int]) -> int:
        key = tuple(sorted(at.items()))
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            ends = [(e, len(self.terms[self.term[n]]), self.term[n]) for n, e in key
                    if self.term[n] >= 0 and e <= allowed(self.terms[self.term[n]])]
            best = min(ends, key=lambda x: (x[0], -x[1], x[2]), default=None)
            self.accept.append((best[2], best[0]) if best else None)
        return self.number[key]

    def _step(self, state: int, c: str) -> int:
        """The next state, or -1 when no term can be reached."""
        out: dict[int, int] = {}
        for node, e in self.states[state]:
            for letter, child in self.children[node].items():      # match or substitution
                cost = e + (letter != c)
                if cost <= self.most[child] and cost < out.get(child, 99):
                    out[child] = cost
            if e < self.most[node] and e + 1 < out.get(node, 99):  # an additional character
                out[node] = e + 1
        nxt = self._state(self._closed(out)) if out else -1
        self.steps[state][c] = nxt
        return nxt

    def match(self, token: str) -> tuple[int, int] | None:
        """(term, edits) of the closest term within its edits, or None."""
        if len(self.states) > self.most_states:
            self._reset()
        state = self.start
        for c in token:
            nxt = self.steps[state].get(c)
            state = self._step(state, c) if nxt is None else nxt
            if state < 0:
                return None
        return self.accept[state]


@dataclass
class Model:
    """Lexicon, known near misses and the weights of the features."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    innocent: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))    # sorted hashes
    weights: list[float] = field(default_factory=lambda: [0.0] * len(FEATURES))
    bias: float = 0.0

    def reader(self) -> Reader:
        return Reader(self)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights) + self.bias, -30, 30)))


FEATURES = ("strongest", "abuse", "quoted", "per_100_words", "exact")


class Reader:
    """Reads texts against a model's lexicon."""

    def __init__(self, model: Model):
        self.model = model
        self.terms = sorted(model.words)
        self.starts = range(0, len(self.terms), PART_TERMS)
        states = max(LEAST_STATES, MAX_STATES // max(1, len(self.starts)))
        self.automata = [Automaton(self.terms[i:i + PART_TERMS], states) for i in self.starts]
        self.memo: dict[str, tuple[float, int] | None] = {}

    def near(self, token: str) -> tuple[int, int] | None:
        """(term, edits) of the closest term of all automata, or None."""
        ends = [(m[1], -len(a.terms[m[0]]), start + m[0]) for start, a in zip(self.starts, self.automata, strict=True)
                if (m := a.match(token)) is not None]
        best = min(ends, default=None)
        return (best[2], best[0]) if best else None

    def _innocent(self, token: str) -> bool:
        known, h = self.model.innocent, _hash(token)
        i = int(np.searchsorted(known, h))
        return i < len(known) and int(known[i]) == h

    def hit(self, token: str) -> tuple[float, int] | None:
        """(weight, edits) of a token of the lexicon, or None."""
        try:
            return self.memo[token]
        except KeyError:
            pass
        m = self.model
        found = None
        if token in m.words:
            found = (m.words[token], 0)
        else:
            stem = next((token[:n] for n in STEMS if token[:n] in m.stems and len(token) > n), None)
            if stem is not None:
                found = (m.stems[stem], 0)
            elif (near := self.near(token)) is not None and not self._innocent(token):
                found = (m.words[self.terms[near[0]]], near[1])
        if len(self.memo) >= MEMO_TOKENS:
            self.memo.clear()
        self.memo[token] = found
        return found

    def features(self, text: str | None) -> list[float]:
        """The features of a whole text; null and empty texts have none."""
        low = (text or "").lower()
        tokens = TOKEN.findall(low)
        hit = self.hit
        found = {t: h for t in set(tokens) if (h := hit(t)) is not None}
        if not found:
            return [0.0] * len(FEATURES)
        spans = [m.span() for m in TOKEN.finditer(low)]
        hits = [(i, found[t]) for i, t in enumerate(tokens) if t in found]
        strongest = abuse = quoted = 0.0
        exact = 0
        for i, (weight, edits) in hits:
            factor = self._context(low, spans, tokens, i)
            part = weight / 5 * 0.6 ** edits * factor
            strongest = max(strongest, part)
            if factor < 1:
                quoted += part
            else:
                abuse += part
                exact += edits == 0
        return [min(strongest, 2.0), math.log1p(abuse), math.log1p(quoted), min(100 * abuse / len(tokens), 10.0), float(exact > 0)]

    @staticmethod
    def _context(low: str, spans: list, tokens: list[str], i: int) -> float:
        """Below 1 for a quoted hit, 1 or above for abuse."""
        lo, hi = max(0, i - WINDOW), min(len(spans), i + WINDOW + 1)
        before, after = low[spans[lo][0]:spans[i][0]], low[spans[i][1]:spans[hi - 1][1] + 2]
        window = tokens[lo:hi]
        factor = 1.0
        if any(q in before for q in QUOTES) and any(q in after for q in QUOTES):
            factor = 0.2 if any(t in REPORTING for t in window) else 0.35
        elif any(t in ADDRESS for t in window):
            factor = 1.25
        return factor


def _odds(toxic: int, clean: int):
    """The log odds ratio of ``t`` toxic against ``n`` clean rows."""
    t, n = F.col("t"), F.col("n")
    return F.log((t + 0.5) / (F.lit(toxic + 0.5) - t)) - F.log((n + 0.5) / (F.lit(clean + 0.5) - n))


def _sure_odds(toxic: int, clean: int):
    """The lower bound of the log odds ratio."""
    return _odds(toxic, clean) - 1.645 * F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("n") + 0.5))


def _term_counts(train: DataFrame) -> DataFrame:
    """``(term, t, n)``: the toxic and the clean rows that hold a word ("=") or a stem ("~")."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = {0: Counter(), 1: Counter()}

        def counted() -> Iterator[pd.DataFrame]:
            for toxic, c in seen.items():
                n = np.fromiter(c.values(), dtype=np.int64, count=len(c))
                if c:                                    # an empty frame has no string column
                    yield pd.DataFrame({"term": list(c), "t": n * toxic, "n": n * (1 - toxic)})
                c.clear()

        for b in batches:
            for text, toxic in zip(b["text"], b["toxic"], strict=True):
                own = set(TOKEN.findall((text or "").lower()))
                seen[toxic].update(["=" + w for w in own])
                seen[toxic].update({"~" + w[:n] for w in own for n in STEMS if len(w) > n})
                if len(seen[toxic]) > MEMO_TOKENS:
                    yield from counted()
        yield from counted()

    return (train.select("text", "toxic").mapInPandas(count, "term string, t long, n long")
            .groupBy("term").agg(F.sum("t").alias("t"), F.sum("n").alias("n")))


def learn_lexicon(terms: DataFrame, toxic: int, clean: int) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems with their log odds, from ``terms(term, t, n)``.

    All words and all prefixes shared by several words of toxic texts are weighed, over all
    labelled rows; only terms that are telling enough come to the driver.
    """
    strong = terms.where((F.col("t") >= LEAST_DOCS) & (_odds(toxic, clean) >= LEAST_ODDS) & (_sure_odds(toxic, clean) >= SURE_ODDS))
    strong = strong.select("term", _odds(toxic, clean).alias("odds"))
    toxic_words = terms.where((F.col("t") > 0) & F.col("term").startswith("=")).select(F.expr("substring(term, 2)").alias("w"))
    prefixes = toxic_words.select(F.explode(F.array(*[F.when(F.length("w") > n, F.substring("w", 1, n)) for n in STEMS])).alias("p"))
    productive = (prefixes.where("p is not null").groupBy(F.concat(F.lit("~"), "p").alias("term"))
                  .agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= LEAST_WORDS).select("term"))
    words = {r["term"][1:]: r["odds"] for r in strong.where(F.col("term").startswith("=")).collect()}
    found = {r["term"][1:]: r["odds"] for r in strong.where(F.col("term").startswith("~")).join(productive, "term", "left_semi").collect()}
    # the shortest stem stands for longer ones and words that are not clearly more telling
    longest: dict[str, float] = {}
    for s, odds in found.items():
        for n in STEMS:
            if n < len(s):
                longest[s[:n]] = max(odds, longest.get(s[:n], -99))
    short: dict[str, float] = {}
    for s in sorted(found, key=len):
        known = [short[s[:n]] for n in STEMS if n < len(s) and s[:n] in short]
        if longest.get(s, -99) <= found[s] + 0.5 and max(known, default=-99) < found[s] - 0.5:
            short[s] = found[s]
    lexicon = {}
    for w, odds in words.items():
        known = [short[w[:n]] for n in STEMS if n < len(w) and w[:n] in short]
        if max(known, default=-99) < odds - 0.5:
            lexicon[w] = odds
    return lexicon, short


def _near_misses(terms: DataFrame, model: Model, toxic: int, clean: int) -> np.ndarray:
    """Tokens within the edits of a term that are words of their own, as sorted hashes.

    A near miss seen in clean rows is weighed like a term, its toxic against its clean rows;
    below the odds of a term it is no misspelling. All that are decided so are kept, 8 bytes each.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = model.reader()
        for b in batches:
            found = [_hash(w) for w in b["w"] if (h := reader.hit(w)) is not None and h[1] > 0]
            yield pd.DataFrame({"h": np.array(found, dtype=np.int64)})

    ordinary = terms.where(F.col("term").startswith("=") & (F.col("n") > 0) & (_odds(toxic, clean) < LEAST_ODDS))
    rows = ordinary.select(F.expr("substring(term, 2)").alias("w")).mapInPandas(find, "h long").toArrow()
    return np.sort(rows["h"].to_numpy())


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> tuple[list[float], float]:
    """Logistic regression by Newton's method; weights and bias."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    penalty = np.diag([ridge * len(x)] * x.shape[1] + [1e-6 * len(x)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + penalty, a.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1].tolist(), float(w[-1])


def train_model(train: DataFrame) -> Model:
    """``train(doc_id, text, toxic)`` -> model.

    Terms are counted over all rows. The weights of the five features are fitted on at most
    ``MAX_FIT_ROWS`` rows, drawn by a hash of the id. Rows with a null label teach nothing;
    without rows of both labels every score is the share of toxic rows (0 without rows).
    """
    train = saved(train.where("toxic in (0, 1)").select("doc_id", "text", "toxic"), "labelled")
    counts = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not clean:
        return Model(bias=30.0 if toxic else -30.0)
    terms = saved(_term_counts(train), "terms")
    words, stems = learn_lexicon(terms, toxic, clean)
    model = Model(words, stems)
    model.innocent = _near_misses(terms, model, toxic, clean)
    share = min(1.0, 0.95 * MAX_FIT_ROWS / (toxic + clean))
    drawn = train.where(F.pmod(seeded(F.col("doc_id"), 4), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = _with_features(drawn, model, ("toxic",)).select("toxic", "x").limit(MAX_FIT_ROWS).collect()
    x, y = np.array([r["x"] for r in rows]).reshape(-1, len(FEATURES)), np.array([r["toxic"] for r in rows], dtype=float)
    if len(set(y.tolist())) == 2:
        model.weights, model.bias = fit_weights(x, y)
    else:
        model.bias = math.log((toxic + 0.5) / (clean + 0.5))
    return model


def _with_features(docs: DataFrame, model: Model, keep: tuple[str, ...]) -> DataFrame:
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = model.reader()
        for b in batches:
            x = [reader.features(t) for t in b["text"]]
            yield b.drop(columns="text").assign(x=x, score=model.score(np.array(x).reshape(-1, len(FEATURES))))

    rows = docs.select(*keep, "text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInPandas(read, f"{kinds}, x array<double>, score double")


def _remainder():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents to learn from: a label, and crc32(doc_id as text) mod 5 not 0.

    Several labels of one id count once; contradicting ones count as toxic. Two bits per id
    (labelled, toxic) are broadcast, so that no text is shuffled. Where ids are so many or so
    sparse that these bitmaps pass ``MAX_LABEL_BYTES``, labelled texts are joined instead.
    """
    marks = saved(labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("__id"))
                  .agg(F.max("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)"), "marks")
    docs = docs.select("doc_id", "text").where(_remainder() != 0).withColumn("__id", F.col("doc_id").cast("long"))
    position = F.bitmap_bit_position("__id")
    buckets = marks.groupBy(F.bitmap_bucket_number("__id").alias("__bucket"))
    if buckets.agg(F.lit(1)).count() * 2 * BITMAP_BYTES > MAX_LABEL_BYTES:
        return sift(docs, "__id", marks, "__id").join(marks, "__id").select("doc_id", "text", "toxic")
    bits = F.broadcast(buckets.agg(
        F.bitmap_construct_agg(position).alias("__known"),
        F.bitmap_construct_agg(F.when(F.col("toxic") == 1, position)).alias("__toxic")))

    def bit(bitmap: str):
        byte = F.expr(f"substring({bitmap}, cast(__bit div 8 as int) + 1, 1)")
        return F.bit_get(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod("__bit", F.lit(8)).cast("int")).cast("int")

    return (docs.withColumn("__bucket", F.bitmap_bucket_number("__id")).withColumn("__bit", position).join(bits, "__bucket")
            .where(bit("__known") == 1).select("doc_id", "text", bit("__toxic").alias("toxic")))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Only texts are scored; null texts score like empty ones, repeated rows each, and an
    empty table gives an empty result. A null id is not held out.
    """
    # saved here: how much a worker gets at once is settled where the job runs
    with arrow_batches(docs.sparkSession, BATCH, BATCH_BYTES):
        model = train_model(labelled_rows(docs, labels))
        scored = saved(_with_features(docs, model, ("doc_id",)).select("doc_id", "score"), "scored")
    return scored.select("doc_id", F.coalesce(_remainder() == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the model calls toxic go; all columns are kept."""
    names = docs.columns
    with arrow_batches(spark, BATCH, BATCH_BYTES):
        model = train_model(labelled_rows(docs, table(spark, sf_dir, "labels")))
        judged = docs.withColumn("__toxic", _toxic_column(model)(F.col("text")))
        return saved(judged.where(~F.col("__toxic")).select(names), "clean")


def _toxic_column(model: Model):
    @F.pandas_udf("boolean")
    def toxic(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = model.reader()
        for t in texts:
            x = np.array([reader.features(v) for v in t]).reshape(-1, len(FEATURES))
            yield pd.Series(model.score(x) >= 0.5)

    return toxic


def op4_lexicon_automaton_toxicity(spark, sf_dir: str) -> DataFrame:
    """The toxicity of every row of ``documents``."""
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
