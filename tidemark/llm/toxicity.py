"""Toxicity by a weighted finite-state grammar over the words of a clause.

Five small transducers read the words of a clause as classes and are composed once into one table.

* Insult: a word that is an insult anywhere counts as it comes. One that is an insult only when it is said of someone
  ("waste", "pig") counts after a target and a copula: ``you are a waste of space``.
* Threat: a harm word counts as it comes. A verb that threatens only by what is meant to be done counts when an
  intent came before it and a target follows: ``i will find you``.
* Target: whether someone is addressed anywhere in the clause. At its end the whole then counts for more, and
  plain harm words count for little if no one is.
* Negation and reported speech: what they govern counts for less.

The insults and harm words and their weights are learned: of the words and word beginnings of sampled labelled
texts, those are taken whose document frequencies differ between the labels beyond chance, at most ``LEXICON``. A
learned word is a threat if it follows an intent in half of the clauses that have it, else an insult. Words of several
parts can be given to a grammar. The other classes and some threats are fixed. A logistic curve fitted on
labelled texts kept apart from that turns the sum and the best of the clause scores into a score from 0 to 1. Only
clauses with a word that can count are walked.

Defined results: a NULL or empty text has no clause and gets the score of that. Labels that are NULL, or
whose doc_id is NULL or repeated with another label, are not learned from. Without both labels the score
is the smoothed share of label 1 (0.5 without labels). Repeated rows get a score each. Other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.common import map_rows, picked, staged
from tidemark.llm.learning import fit_logistic, sampled, sigmoid

# Sampled texts of each label, and the most hit words.
SAMPLE = 6000
LEXICON = 2000
# Least likelihood ratio of a hit word: chance alone passes it for about one in a million words.
LEAST_RATIO = 24.0
LEAST_DOCUMENTS = 3
BEGINNINGS = (4, 5, 6, 7)

CLASSES = range(10)
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, COPULA, SAID_OF, INTENT, PURSUIT = CLASSES

# Words of the classes that are not learned.
THREATS = {
    "kill": 2.0, "murder": 2.0, "hurt": 1.5, "destroy": 1.5, "stab": 2.0, "shoot": 2.0, "strangle": 2.0,
    "töten": 2.0, "umbringen": 2.0, "tuer": 2.0, "matar": 2.0, "mataré": 2.0,
}
TARGETS = "you your yours u ur du dich dir euch dein tu te toi ton vous votre tú ti vosotros usted ustedes".split()
NEGATIONS = "not no never neither nor isn't aren't don't won't nicht kein keine nie ne pas jamais nunca jamás".split()
REPORTS = (
    "said says wrote writes called calls quoted reported alleged claimed according sagte schrieb nannte "
    "zitierte dit écrit disait appelé dijo escribió llamó"
).split()
COPULAS = "are is am be were was bist seid ist es êtes sont eres sois".split()
SAID_OF_SOMEONE = (
    "waste trash garbage disgrace loser pig rat worm scum clown joke failure vermin abfall müll schwein versager "
    "ungeziefer ordure déchet cochon raté basura cerdo perdedor fracaso"
).split()
INTENTS = "will shall going gonna must werde werden vais va voy vamos".split()
PURSUITS = (
    "find get catch make hunt come pay regret suffer burn finden kriegen holen trouver attraper brûler "
    "encontrar atrapar quemar"
).split()
# read as two words
SPLIT = {
    "you're": "you are", "u're": "you are", "i'll": "i will", "we'll": "we will", "they'll": "they will",
    "he'll": "he will", "she'll": "she will",
}

# The weights of the grammar.
NEGATED = 0.25
NEGATION_REACH = 3
REPORTED = 0.5
ADDRESSED = 1.5
UNADDRESSED_THREAT = 0.25
SAID_OF_WEIGHT = 1.0
PURSUIT_WEIGHT = 1.0

_BOUNDARY = re.compile(r"[.,;:!?|\n]")
_WORD = re.compile(r"\w+(?:'\w+)?")


# Each machine: (state, class) -> (state, factor of what the word counts).


def _insult(state: int, word: int) -> tuple[int, float]:
    """State: a target has come, and then a copula. What is an insult only of someone needs both."""
    after = max(state, 1) if word == TARGET else 2 if word == COPULA and state else state
    return after, float(state == 2) if word == SAID_OF else 1.0


def _threat(state: int, word: int) -> tuple[int, float]:
    """State: an intent has come, and then a verb of pursuit, which makes a threat of the target that follows."""
    if word == INTENT:
        return max(state, 1), 1.0
    if word == PURSUIT and state:
        return 2, 1.0
    if word == TARGET:
        return min(state, 1), float(state == 2)
    return state, 1.0


def _target(state: int, word: int) -> tuple[int, float]:
    return int(state or word == TARGET), 1.0


def _negation(state: int, word: int) -> tuple[int, float]:
    """State: how many words the negation still reaches."""
    if word == NEGATION:
        return NEGATION_REACH, 1.0
    return max(0, state - 1), NEGATED if state else 1.0


def _report(state: int, word: int) -> tuple[int, float]:
    return int(state or word == REPORT), REPORTED if state else 1.0


MACHINES = (_insult, _threat, _target, _negation, _report)


def composed() -> tuple[dict[tuple[int, int], tuple[int, float]], list[bool]]:
    """({(state, class): (state, factor of the word)}, whether each state has seen a target)."""
    begin = (0,) * len(MACHINES)
    numbers = {begin: 0}
    waiting = [begin]
    table: dict[tuple[int, int], tuple[int, float]] = {}
    while waiting:
        states = waiting.pop()
        for word in CLASSES:
            steps = [m(s, word) for m, s in zip(MACHINES, states)]
            after = tuple(s for s, _ in steps)
            if after not in numbers:
                numbers[after] = len(numbers)
                waiting.append(after)
            table[numbers[states], word] = numbers[after], math.prod(f for _, f in steps)
    return table, [s[MACHINES.index(_target)] > 0 for s in sorted(numbers, key=numbers.get)]


@dataclass
class Grammar:
    """Hits: whole words or several, and beginnings, with their weights; the weights of the curve; which hits are
    threats."""

    words: dict[str, float] = field(default_factory=dict)
    beginnings: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)
    threats: frozenset[str] = frozenset()

    def scorer(self):
        walker = Walker(self)
        return lambda text: sigmoid(float(np.dot(self.weights, walker.features(text))))


class Walker:
    def __init__(self, grammar: Grammar):
        self.grammar = grammar
        self.table, self.addressed = composed()
        self.classes = {}
        for words, kind in (
            (PURSUITS, PURSUIT),
            (INTENTS, INTENT),
            (SAID_OF_SOMEONE, SAID_OF),
            (COPULAS, COPULA),
            (REPORTS, REPORT),
            (NEGATIONS, NEGATION),
            (TARGETS, TARGET),
        ):
            self.classes |= dict.fromkeys(words, kind)
        self.lengths = sorted({len(b) for b in grammar.beginnings})
        # hits of several words, by their first one, the longest first
        self.phrases: dict[str, list[list[str]]] = {}
        for hit in sorted(grammar.words, key=len, reverse=True):
            words = _WORD.findall(hit)
            if len(words) > 1:
                self.phrases.setdefault(words[0], []).append(words)
        counting = {*grammar.words, *grammar.beginnings, *self.phrases, *THREATS, *SAID_OF_SOMEONE, *PURSUITS}
        self.finder = ahocorasick.Automaton()
        for word in counting:
            self.finder.add_word(word, len(word))
        self.finder.make_automaton()

    def hit(self, word: str) -> str | None:
        """The learned word or beginning that counts most here."""
        if word in self.grammar.words:
            return word
        starts = [word[:n] for n in self.lengths if word[:n] in self.grammar.beginnings]
        return max(starts, key=self.grammar.beginnings.get, default=None)

    def classify(self, word: str) -> tuple[int, float]:
        """(class, weight where it counts)."""
        hit = self.hit(word)
        if hit is not None:
            weight = self.grammar.words.get(hit) or self.grammar.beginnings.get(hit, 0.0)
            return (THREAT if hit in self.grammar.threats or word in THREATS else INSULT), weight
        if word in THREATS:
            return THREAT, THREATS[word]
        kind = self.classes.get(word, OTHER)
        return kind, {SAID_OF: SAID_OF_WEIGHT, TARGET: PURSUIT_WEIGHT}.get(kind, 0.0)

    def words(self, text: str) -> list[str]:
        """Words of a clause; those that a hit has several of are one."""
        found = []
        for word in _WORD.findall(text):
            found += SPLIT[word].split() if word in SPLIT else [word]
        if not self.phrases:
            return found
        joined, at = [], 0
        while at < len(found):
            ways = self.phrases.get(found[at], [])
            size = next((len(w) for w in ways if found[at : at + len(w)] == w), 1)
            joined.append(" ".join(found[at : at + size]))
            at += size
        return joined

    def clause(self, text: str) -> float:
        state, insults, threats, pursued = 0, 0.0, 0.0, 0.0
        for word in self.words(text):
            kind, weight = self.classify(word)
            state, factor = self.table[state, kind]
            if kind in (INSULT, SAID_OF):
                insults += weight * factor
            elif kind == THREAT:
                threats += weight * factor
            elif kind == TARGET:
                pursued += weight * factor
        if self.addressed[state]:
            return ADDRESSED * (insults + threats + pursued)
        return insults + UNADDRESSED_THREAT * threats

    def after_intent(self, text: str | None) -> list[tuple[str, bool]]:
        """Each hit of the text, once for a clause, and whether an intent came before it there."""
        found: list[tuple[str, bool]] = []
        for clause in _BOUNDARY.split((text or "").lower()):
            meant, seen = False, {}
            for word in self.words(clause):
                hit = self.hit(word)
                if hit is not None:
                    seen[hit] = seen.get(hit, False) or meant
                meant = meant or self.classes.get(word) == INTENT
            found += seen.items()
        return found

    def features(self, text: str | None) -> tuple[float, float, float]:
        """1, the logarithm of the sum of the clause scores, and the best of them."""
        lowered = (text or "").lower().replace("\u2019", "'")
        ends = [
            end
            for end, size in self.finder.iter(lowered)
            if end == size - 1 or not lowered[end - size].isalnum()
        ]
        if not ends:
            return 1.0, 0.0, 0.0
        borders = [-1, *(m.start() for m in _BOUNDARY.finditer(lowered)), len(lowered)]
        total = best = 0.0
        for i in sorted({bisect_left(borders, end) for end in ends}):
            found = self.clause(lowered[borders[i - 1] + 1 : borders[i]])
            total += found
            best = max(best, found)
        return 1.0, math.log1p(total), best


def terms(text: str | None) -> list[str]:
    """Words, and their beginnings marked with a star, each once."""
    words = set(_WORD.findall((text or "").lower()))
    starts = {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) > n}
    return sorted(w for w in words | starts if not w.isdigit())


def lexicon(known: DataFrame, size: int = LEXICON) -> tuple[dict[str, float], dict[str, float]]:
    """Whole words and beginnings whose document frequency is higher at label 1 than chance explains."""
    totals = dict(known.groupBy("label").count().collect())
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return {}, {}
    listed = map_rows(known.drop("doc_id"), lambda: lambda text: (terms(text),), "terms array<string>", ("label",))
    counts = listed.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count_if(F.col("label") == 1).cast("double").alias("k1"),
        F.count_if(F.col("label") == 0).cast("double").alias("k0"),
    )
    share = F.lit(bad / (bad + good))
    both = F.col("k1") + F.col("k0")
    part = lambda k, p: F.when(k > 0, k * F.ln(k / (both * p))).otherwise(0.0)
    ratio = 2 * (part(F.col("k1"), share) + part(F.col("k0"), 1 - share))
    odds = F.ln((F.col("k1") + 0.5) / (bad + 1.0)) - F.ln((F.col("k0") + 0.5) / (good + 1.0))
    scored = counts.where(F.col("k1") >= LEAST_DOCUMENTS).select("term", ratio.alias("ratio"), odds.alias("odds"))
    found = scored.where((F.col("ratio") >= LEAST_RATIO) & (F.col("odds") >= 2.0))
    words: dict[str, float] = {}
    beginnings: dict[str, float] = {}
    for r in found.orderBy(F.desc("ratio"), F.length("term"), "term").limit(size).collect():
        stem = r.term.rstrip("*")
        if any(stem.startswith(b) or b.startswith(stem) for b in beginnings):
            continue
        (beginnings if r.term.endswith("*") else words)[stem] = r.odds
    return words, beginnings


def learned_threats(known: DataFrame, grammar: Grammar) -> frozenset[str]:
    """Hits that follow an intent in at least half of the toxic clauses that have them; at most ``LEXICON`` rows come."""

    def start():
        walker = Walker(grammar)
        return lambda text: ([{"hit": h, "meant": m} for h, m in walker.after_intent(text)],)

    toxic = known.where("label = 1").select("text")
    found = map_rows(toxic, start, "hits array<struct<hit:string, meant:boolean>>", ())
    each = found.select(F.explode("hits").alias("of")).select("of.*").groupBy("hit").agg(
        F.count_if("meant").alias("meant"), F.count("*").alias("n")
    )
    return frozenset(r.hit for r in each.where(f"n >= {LEAST_DOCUMENTS} AND 2 * meant >= n").collect())


def fit(
    df: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    learn: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
) -> Grammar:
    """Hit words from two of three sampled texts, the curve from the third ones.

    The driver gets at most ``LEXICON`` words and three numbers for each sampled text of the third part.
    """
    known = staged(sampled(df, labels, label, learn, sample, doc_id, text), "sample")
    # many near copies of one text would make any word of theirs look telling
    known = staged(simhash.one_of_each(known), "sample")
    third = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0
    grammar = Grammar(*lexicon(known.where(~third)))
    if grammar.words or grammar.beginnings:
        grammar.threats = learned_threats(known.where(~third), grammar)
    counts = dict(known.groupBy("label").count().collect())
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    grammar.weights = (math.log(share / (1 - share)), 0.0, 0.0)

    def start():
        walker = Walker(grammar)
        return lambda text: (list(walker.features(text)),)

    measured = map_rows(known.where(third), start, "x array<double>", ("doc_id", "label"))
    held = measured.orderBy("doc_id").collect()
    if len({r.label for r in held}) == 2:
        x, y = np.array([r.x for r in held]), np.array([r.label for r in held], float)
        grammar.weights = tuple(fit_logistic(x, y).tolist())
    return grammar


def score(df: DataFrame, grammar: Grammar, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""

    def start():
        of = grammar.scorer()
        return lambda value: (of(value),)

    return map_rows(picked(df, doc_id=doc_id, text=text), start, "score double")
