"""Toxicity scores from a lexicon trie, a Levenshtein automaton and context windows.

1. A lexicon is learned from a bounded sample of labelled documents: words,
   and word stems (a prefix that goes on in several ways), that are much more
   frequent in documents marked toxic. A few fixed terms are always in it.
2. The lexicon is a trie. A Levenshtein automaton of the document word runs
   over the trie, so misspelled terms are found without comparing the word
   with every term: a branch in which no state is left is cut. Words of ordinary documents that merely resemble a term are learned
   as exceptions; a term that many of them resemble is matched exactly only.
3. Each match weighs its term's evidence, less for each edit. A match inside
   quotation marks, or after words that introduce a citation, counts as a
   citation. The densest window of words shows concentrated abuse.
4. A logistic model over these sums, fitted to the same sample, gives a score
   between 0 and 1.

Defined cases: NULL and empty texts match nothing and get the score of a text
without matches. NULL ids take part and are not held out. Labels that
contradict each other for one id count as toxic. With no labels the fixed
terms and fixed weights are used. Extra columns are ignored or passed
through; repeated rows are scored alike.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import Shared, append_columns, hashed_sample, held_out, prepare, table, written

#: Labelled rows used for learning, per class (those with the smallest key hash).
SAMPLE_ROWS = 10_000
#: A term occurs in so many toxic documents of the sample, and in such a share of them.
MIN_SUPPORT, MIN_SHARE = 5, 0.005
MIN_ODDS = 3.0
WINDOW = 8
#: Lengths of word stems that may be learned.
STEMS = (4, 5, 6, 7)

# Terms that are in every lexicon.
SEED_TERMS = ("idiot", "imbecile", "moron", "scumbag", "worthless", "pathetic", "disgusting", "stupid",
              "dummkopf", "vollidiot", "connard", "abruti", "gilipollas", "imbécil")
# Words that introduce a citation of the words behind them.
CITE_WORDS = frozenset("called calls word words term quote quoted quotes said says wrote writes reported "
                       "nannte wort zitat sagte mot citation dit écrit palabra cita dijo".split())
# Opening quotation marks and what closes them.
QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»", "‘": "’"}

WORD = re.compile(r"[^\W\d_]+")
FEATURES = 4
FALLBACK = (-3.0, 1.5, 0.2, 0.8, 0.3)


class LexiconTrie:
    """Trie of terms; a node is a dict of children, with the term at its end.

    Terms of `fuzzy_from` letters or more are matched with up to `edits` edits,
    but for those in exact_only and for stems ('stem*').
    """

    def __init__(self, terms: dict[str, float], exact_only=frozenset(), edits: int = 1, fuzzy_from: int = 5):
        self.weights, self.edits, self.exact_only = terms, edits, frozenset(exact_only)
        self.root: dict = {}
        for term in terms:
            node = self.root
            for c in term.rstrip("*"):
                node = node.setdefault(c, {})
            node["*" if term.endswith("*") else ""] = term
        self.fuzzy = {t for t in terms if len(t) >= fuzzy_from and not t.endswith("*") and t not in self.exact_only}
        # one edit leaves a term's first or its last half alone: a cheap test before the walk
        self.heads = {t[:2 if len(t) < 6 else 3] for t in self.fuzzy}
        self.tails = {t[-3:] for t in self.fuzzy}

    def match(self, word: str) -> tuple[str, int] | None:
        """The best (term, edits) for a word: fewest edits, then the longest term."""
        exact = self._exact(word)
        if exact:
            return exact, 0
        if len(word) < 4 or (self.edits == 1 and word[:2] not in self.heads and word[:3] not in self.heads
                             and word[-3:] not in self.tails):
            return None
        return self._automaton(word)

    def _exact(self, word):
        node, stem = self.root, None
        for c in word:
            stem = node.get("*", stem)
            node = node.get(c)
            if node is None:
                return stem
        return node.get("") or node.get("*") or stem

    def _automaton(self, word):
        """Intersection of the trie with the automaton of all words within the allowed distance.

        State d is a bit set of word positions reached with d edits. Bit n is the word's end.
        """
        n, best = len(word), None
        place: dict[str, int] = {}
        for i, c in enumerate(word):
            place[c] = place.get(c, 0) | 1 << i
        full, end = (1 << (n + 1)) - 1, 1 << n
        stack = [(self.root, 0, 1, 3, 7)]
        while stack:
            node, depth, s0, s1, s2 = stack.pop()
            depth += 1
            for c, child in node.items():
                if len(c) != 1 or c == "*":
                    continue
                at = place.get(c, 0)
                t0 = (s0 & at) << 1
                t1 = ((s1 & at) << 1 | s0 | s0 << 1 | t0 << 1) & full
                t2 = ((s2 & at) << 1 | s1 | s1 << 1 | t1 << 1) & full if self.edits > 1 else t1
                if not t2:
                    continue
                term = child.get("")
                if term in self.fuzzy and t2 & end:
                    edits = 0 if t0 & end else 1 if t1 & end else 2
                    if best is None or (edits, -len(term), term) < (best[1], -len(best[0]), best[0]):
                        best = (term, edits)
                stack.append((child, depth, t0, t1, t2))
        return best


class ToxicityModel:
    """Lexicon, exceptions and logistic weights; small enough to be broadcast (bounds above)."""

    def __init__(self, terms, exceptions=frozenset(), exact_only=frozenset(), weights=FALLBACK):
        self.trie = LexiconTrie(terms, exact_only)
        self.exceptions = frozenset(exceptions)
        self.weights = tuple(weights)

    def matcher(self, cache_words: int = 500_000):
        """word -> evidence of its match, or None; remembers words, in bounded memory."""
        seen: dict = {}
        trie, exceptions = self.trie, self.exceptions

        def look(word):
            try:
                return seen[word]
            except KeyError:
                hit = trie.match(word)
                if hit and hit[1] and word in exceptions:
                    hit = None
                if len(seen) >= cache_words:
                    seen.clear()
                seen[word] = out = hit and trie.weights[hit[0]] * 0.7 ** hit[1]
                return out
        return look

    def features(self, text: str | None, look) -> tuple[float, ...]:
        """log1p of: evidence outside citations, cited evidence, densest window, and matches per 100 words."""
        if not text:
            return (0.0,) * FEATURES
        low = text.lower()
        words = WORD.findall(low)
        evidence = [(i, e) for i, e in enumerate(map(look, words)) if e]
        if not evidence:
            return (0.0,) * FEATURES
        cited = citations(low, words, {i for i, _ in evidence})
        free = [(i, e) for i, e in evidence if i not in cited]
        best = total = 0.0
        start = 0
        for k, (i, e) in enumerate(free):
            total += e
            while free[start][0] <= i - WINDOW:
                total -= free[start][1]
                start += 1
            best = max(best, total)
        return (math.log1p(sum(e for _, e in free)), math.log1p(sum(e for i, e in evidence if i in cited)),
                math.log1p(best), math.log1p(100.0 * len(free) / len(words)))

    def score(self, features) -> float:
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], features))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def citations(low: str, words: list[str], places: set[int]) -> set[int]:
    """Which of the word places stand inside quotation marks or right behind a citing word."""
    out = {i for i in places if any(w in CITE_WORDS for w in words[max(0, i - 3):i])}
    if any(q in low for q in QUOTES):
        spans, opened, close = [], None, None
        for k, c in enumerate(low):
            if close is not None:
                if c == close:
                    spans.append((opened, k))
                    close = None
                elif c == "\n":
                    close = None
            elif c in QUOTES:
                opened, close = k, QUOTES[c]
        if spans:
            at = 0
            for i, m in enumerate(WORD.finditer(low)):
                while at < len(spans) and spans[at][1] <= m.start():
                    at += 1
                if i in places and at < len(spans) and spans[at][0] < m.start() < spans[at][1]:
                    out.add(i)
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(text, y): at most `rows` labelled documents of each class outside the held-out fold.

    Which ones is settled on the labels alone, by key hash, before any text is
    read. They are at most 2 * rows keys, so they are broadcast.
    """
    known = (labels.select(F.col(key).alias("k"), F.col(label).alias("y")).where("k IS NOT NULL AND y IS NOT NULL")
             .where(~held_out(F.col("k"))).groupBy("k").agg(F.max("y").cast("int").alias("y")))
    picked = [hashed_sample(known.where(F.col("y") == y), rows, "k") for y in (0, 1)]
    chosen = picked[0].unionByName(picked[1])
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(chosen), "k").select(
        F.coalesce("t", F.lit("")).alias("t"), "y")


def spread(sample: DataFrame) -> DataFrame:
    """The sample with near copies taken once, so that one text copied often makes no term.

    Documents that agree in class and in one of two minimum shingle hashes count as copies.
    """
    def make():
        def run(cols):
            low = [[], []]
            for t in cols[0]:
                w = WORD.findall(t.lower())
                hashes = {zlib.crc32(" ".join(w[i:i + 5]).encode()) for i in range(max(1, len(w) - 4))}
                low[0].append(min(hashes))
                low[1].append(min(h * 2654435761 % 4294967296 for h in hashes))
            return low
        return run
    marked = append_columns(sample, ["t"], "m1 long, m2 long", make)
    # of each group the least text stays, so that the same sample gives the same terms in every run
    once = marked.groupBy("y", "m1").agg(F.min(F.struct("t", "m2")).alias("s")).select("y", "s.t", "s.m2")
    return once.groupBy("y", "m2").agg(F.min("t").alias("t")).select("t", "y")


def term_counts(sample: DataFrame) -> DataFrame:
    """(term, toxic, clean): documents of each class that hold a word, or a word going on from a stem."""
    def run(batches):
        seen = (Counter(), Counter())
        for b in batches:
            for t, y in zip(b.column("t").to_pylist(), b.column("y").to_pylist()):
                words = set(WORD.findall(t.lower()))
                seen[y].update(words)
                seen[y].update({w[:n] + "*" for w in words for n in STEMS if len(w) > n})
            if sum(map(len, seen)) > 400_000:
                yield _counted(seen)
                seen = (Counter(), Counter())
        if any(seen):
            yield _counted(seen)
    parts = sample.mapInArrow(run, "term string, toxic long, clean long")
    return parts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _counted(seen):
    terms = list(seen[0].keys() | seen[1].keys())
    return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()),
                                       pa.array([seen[1][t] for t in terms], pa.int64()),
                                       pa.array([seen[0][t] for t in terms], pa.int64())],
                                      names=["term", "toxic", "clean"])


def choose_terms(rows: list, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Lexicon {term: weight} of the counted candidates. A stem replaces the terms it covers."""
    terms = {t: MIN_ODDS for t in SEED_TERMS}
    odds = {r.term: math.log((r.toxic + 0.5) / (n_toxic + 1.0)) - math.log((r.clean + 0.5) / (n_clean + 1.0))
            for r in rows}
    words = [t for t in odds if not t.endswith("*")]
    ways = Counter(w[:n] + "*" for w in words for n in STEMS if len(w) > n)
    stems: set[str] = set()
    for t in sorted(odds, key=len):
        if t.endswith("*") and ways[t] >= 3 and not any(t[:n] + "*" in stems for n in STEMS if n < len(t) - 1):
            stems.add(t)
    for t, w in odds.items():
        bare = t.rstrip("*")
        covered = any(bare[:n] + "*" in stems and bare[:n] + "*" != t for n in STEMS)
        if (t in stems) or (not t.endswith("*") and not covered):
            terms[t] = w
    return terms


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Newton steps of a ridge logistic regression with intercept."""
    z = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(h, z.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn lexicon, exceptions and weights from the labelled training fold (bounded sample)."""
    sample = written(spread(labelled_sample(docs, labels, "toxic", sample_rows)), "toxicity-sample")
    sizes = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return ToxicityModel({t: MIN_ODDS for t in SEED_TERMS})
    n_toxic, n_clean = sizes[1], sizes[0]
    counts = written(term_counts(sample), "toxicity-terms")
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    # every term with the support and odds: both ask for a share of the bounded sample, so they are few
    rows = counts.where((F.col("toxic") >= max(MIN_SUPPORT, MIN_SHARE * n_toxic)) & (odds >= MIN_ODDS)) \
        .orderBy(F.desc("toxic"), "term").collect()
    trie = LexiconTrie(choose_terms(rows, n_toxic, n_clean))
    near = append_columns(counts.where("clean > 0 AND term NOT LIKE '%*'").select("term", "toxic", "clean"),
                          ["term"], "edits int, target string", _near(trie))
    exceptions = near.where((F.col("edits") > 0) & (odds < MIN_ODDS)) \
        .orderBy(F.desc("clean"), "term").select("term", "target").collect()
    crowded = Counter(r.target for r in exceptions)
    model = ToxicityModel(trie.weights, [r.term for r in exceptions], {t for t, n in crowded.items() if n >= 3})
    rows = _features(sample, Shared(docs.sparkSession, model)).select("y", "f").collect()
    x, y = np.array([r.f for r in rows]), np.array([r.y for r in rows], dtype=float)
    order = np.lexsort((*x.T, y))  # sums in one order, whatever the order of arrival
    return ToxicityModel(trie.weights, model.exceptions, model.trie.exact_only, fit_logistic(x[order], y[order]))


def _near(trie):
    def make():
        def run(cols):
            hits = [trie.match(w) or (None, None) for w in cols[0]]
            return [[h[1] for h in hits], [h[0] for h in hits]]
        return run
    return make


def _features(rows, shared):
    def make():
        model = shared.value
        look = model.matcher()

        def run(cols):
            return [[list(model.features(t, look)) for t in cols[0]]]
        return run
    return append_columns(rows, ["t"], "f array<double>", make)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Every row of docs with its toxicity score. Narrow: one map over the texts."""
    shared = Shared(docs.sparkSession, model)

    def make():
        model = shared.value
        look = model.matcher()

        def run(cols):
            return [[model.score(model.features(t, look)) for t in cols[0]]]
        return run
    return append_columns(docs, [text], "toxicity double", make)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract digest: score and prediction of every document, labels learned off the held-out fold."""
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
