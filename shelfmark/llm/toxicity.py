"""Toxicity: a weighted finite-state pattern grammar over clauses.

Words are mapped to classes (insults, negative predicates, verbs of violence and of hate, intent, target, copula, negation,
reported speech, a clause's end, ...). Five transducers read and write classes:

- threat: a verb of violence becomes a threat by a target that follows it ("kill you", "kill them"), unless an article comes next
  ("burn you a CD", "kill the process"); so do "go die" and "you will die";
- insult: nouns of abuse are insults; a negative predicate becomes one after a target, either at once ("you useless ...") or by
  way of a copula ("they are so stupid"); a verb of hate becomes one by a target that follows;
- negation turns an insult or threat that follows it closely into a denied one;
- reported speech turns one into a quoted one until the clause ends;
- target adds a directed one if the clause also names somebody.

They are composed into one machine, which runs over those clauses that hold a word of abuse, hate, violence or death; what comes out is
counted. A document's score is logistic in the weights of its matched clauses.

The lists below give the grammar's closed classes and seeds of the open ones; further insults, of any language,
are induced from training labels: words whose presence speaks for the label with at least ``SUPPORT`` documents and
``PRECISION``. Both steps fit on at most ``SAMPLE`` labelled rows; the lexicon is bounded by ``LEXICON``. Scoring is
one scan over whole texts; nothing is shuffled.

Nulls and edges: a null text is empty and scores like one without a match; without labels of both kinds the score
rests on fixed weights, which are also what weights are drawn to where the sample says little; a null doc_id is passed on, not held out; repeated rows give repeated rows; a very long text is one
row, whose words' places are held; of induced words that are equally frequent the smaller come first; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm._fit import held_out, labelled_sample, logistic, sigmoid
from shelfmark.llm._session import table, written
from shelfmark.llm._text import ALNUM, pieces, spans, word_hashes

SAMPLE, LEXICON = 20_000, 2_000
SUPPORT, PRECISION = 4, 0.8
L2 = 1e-3
CUT = 0.7
FOLDS, HELD_OUT = 3, 1
#: Words after a negation that it still reaches.
REACH = 3

#: The closed classes and the seeds of the open ones.
WORDS = {
    "insult": "idiot idiots moron morons scum trash clown loser losers imbecile vermin filth bastard bastards cretin cretins bitch pig swine dumbass asshole fool fools waste parasite parasites",
    "predicate": "stupid pathetic worthless disgusting useless dumb ugly ignorant hopeless brainless vile idiotic contemptible dumm wertlos nutzlos stupide inutile",
    "hate": "hate hates despise despises detest loathe hasse déteste odio",
    "violence": "kill kills hurt hurts destroy burn shoot stab murder strangle hang beat smash choke töten umbringen tuer matar",
    "death": "die rot perish suffer sterben mourir morir",
    "intent": "will ll shall gonna going want must werde werden vais voy",
    "go": "go please",
    "article": "a an the some this that these those ein eine das den une le la un una el",
    "target": "you your yours yourself u ya they them their he him she her people everyone du dich dir ihr euch tu te toi vous tú ti usted ustedes",
    "copula": "are is re am was were be bist seid sind es est sont eres son",
    "negation": "not never no neither nor cannot isn aren wasn don doesn didn won nicht kein keine keinen nie ne pas jamais nunca jamás",
    "report": "said says say wrote writes called calls claimed claims reported reports quoted quotes told according sagte sagt schrieb dit disait écrit dijo dice escribió",
}
CLASSES = ("other", "end", *WORDS)
#: Words of these make a clause worth a look.
HOT = ("insult", "predicate", "hate", "violence", "death")
#: What the composed machine counts in matched clauses; the last ones are no match by themselves.
OUT = ("insult", "directed insult", "denied insult", "quoted insult", "threat", "directed threat", "denied threat", "quoted threat", "violence", "predicate")
MATCHES = 8

_TOKEN = re.compile(r"[0-9a-z\x80-\U0010ffff]+")

Machine = dict[tuple[object, str], tuple[object, tuple[str, ...]]]


def threatening(symbols: tuple[str, ...]) -> Machine:
    """States: nothing; a verb, and how many more words may stand before its target; a verb and its target, which the next word
    may still make harmless; a call to go; a target, a target's future."""
    out: Machine = {}
    for state in ("", "verb 2", "verb 1", "struck", "go", "target", "future"):
        for x in symbols:
            first = ("threat",) if state == "struck" and x != "article" else ()
            to, more = "", ()
            if x == "violence":
                to = "verb 2"
            elif x == "target":
                to = "struck" if state.startswith("verb") else "target"
            elif x == "go":
                to = "go"
            elif x == "intent" and state == "target":
                to = "future"
            elif x == "death" and state in ("go", "future"):
                more = ("threat",)
            elif state == "verb 2" and x == "other":
                to = "verb 1"
            elif state == "future" and x == "other":
                to = "future"
            out[state, x] = to, (*first, x, *more)
    return out


def insulting(symbols: tuple[str, ...]) -> Machine:
    """States: nothing; hate that waits for its target; a target just named; one with a copula."""
    out: Machine = {}
    for state in ("", "hate", "target", "copula"):
        for x in symbols:
            to, written = state if state == "copula" else "", (x,)
            if x == "end":
                to = ""
            elif x == "hate":
                to = "hate"
            elif x == "target":
                to, written = "target", ("insult", x) if state == "hate" else (x,)
            elif x == "copula" and state == "target":
                to = "copula"
            elif x == "predicate" and state in ("target", "copula"):
                to, written = state, ("insult",)
            elif state == "target" and x in ("article", "threat"):
                to = state
            out[state, x] = to, written
    return out


def negation(symbols: tuple[str, ...]) -> Machine:
    """States: words that the last negation still reaches."""
    out: Machine = {}
    for left in range(REACH + 1):
        for x in symbols:
            if x == "end":
                out[left, x] = 0, (x,)
            elif x == "negation":
                out[left, x] = REACH, (x,)
            else:
                out[left, x] = max(0, left - 1), (f"denied {x}" if left and x in ("insult", "threat") else x,)
    return out


def reporting(symbols: tuple[str, ...]) -> Machine:
    """States: has the clause a verb of saying so far."""
    return {(said, x): (x != "end" and (said or x == "report"), (f"quoted {x}" if said and x in ("insult", "threat") else x,)) for said in (False, True) for x in symbols}


def targeting(symbols: tuple[str, ...]) -> Machine:
    """States: what waits for a target in this clause, or that one was named."""
    out: Machine = {}
    for state in ("", "named", "insult", "threat"):
        for x in symbols:
            if x == "end":
                out[state, x] = "", (x,)
            elif x == "target":
                out[state, x] = "named", (f"directed {state}", x) if state in ("insult", "threat") else (x,)
            elif x in ("insult", "threat"):
                out[state, x] = ("named", (x, f"directed {x}")) if state == "named" else (x, (x,))
            else:
                out[state, x] = state, (x,)
    return out


def compose(first: Machine, start_a: object, second: Machine, start_b: object) -> Machine:
    """What second writes when it reads what first writes, over the states that can be reached."""
    out, todo, symbols = {}, [(start_a, start_b)], {x for _, x in first}
    while todo:
        state = todo.pop()
        for x in symbols:
            a, written = first[state[0], x]
            b, emitted = state[1], []
            for y in written:
                b, z = second[b, y]
                emitted += z
            if (state, x) not in out:
                out[state, x] = (a, b), tuple(emitted)
                if ((a, b), x) not in out:
                    todo.append((a, b))
    return out


def cascade() -> list[tuple[Machine, object]]:
    """The transducers in order, each over what the one before writes, with their first states."""
    out, symbols = [], CLASSES
    for make, start in ((threatening, ""), (insulting, ""), (negation, 0), (reporting, False), (targeting, "")):
        machine = make(symbols)
        out.append((machine, start))
        symbols = tuple(dict.fromkeys(y for _, written in machine.values() for y in written))
    return out


def grammar() -> tuple[Machine, object]:
    """The composed machine and its first state."""
    (machine, state), *rest = cascade()
    for more, start in rest:
        machine, state = compose(machine, state, more, start), (state, start)
    return machine, state


def words(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def induce(sample: DataFrame, most: int = LEXICON) -> dict[str, float]:
    """Words that speak for the label, with their log odds: counted by documents, summed before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad, good, n = Counter(), Counter(), [0, 0]
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (bad if label else good).update(set(words(text)))
                n[bool(label)] += 1
            names = list(bad.keys() | good.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array([*names, None], pa.string()), pa.array([*(bad[w] for w in names), n[1]], pa.int64()), pa.array([*(good[w] for w in names), n[0]], pa.int64())],
                names=["w", "bad", "good"],
            )

    counts = sample.select("text", "label").mapInArrow(count, "w string, bad long, good long").groupBy("w").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    found = counts.filter(F.col("w").isNull() | ((F.col("bad") >= SUPPORT) & (F.col("bad") >= PRECISION * (F.col("bad") + F.col("good")))))
    rows = found.orderBy(F.col("w").isNotNull(), F.desc("bad"), "w").limit(most + 1).collect()
    if not rows or rows[0].w is not None:
        return {}
    odds = lambda a, b: np.log(a + 0.5) - np.log(b + 0.5)
    return {r.w: float(odds(r.bad, r.good) - odds(rows[0].bad, rows[0].good)) for r in rows[1:]}


class Scorer:
    """The lexicon, by hash, and the machine."""

    def __init__(self, induced: dict[str, float]):
        classes = {w: c for c, ws in WORDS.items() for w in ws.split()}
        classes |= {w: "insult" for w in induced if classes.get(w, "insult") in ("insult", "predicate")}
        names = sorted(classes)
        raw = " ".join(names).encode()
        hashes = word_hashes(raw, *spans(raw, ALNUM))
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.classes = [classes[names[i]] for i in order]
        self.hot = np.array([c in HOT for c in self.classes])
        usual = float(np.median([*induced.values()])) if induced else 1.0  # of listed words that the sample doesn't hold often enough
        self.weights = [max(0.5, induced.get(names[i], usual)) for i in order]
        self.machine, self.start = grammar()

    def clauses(self, texts: list[str | None]) -> np.ndarray:
        """For each text: the summed weights of each kind of output, then the number of matched clauses."""
        out = np.zeros((len(texts), len(OUT) + 1))
        for first, buf, begins in pieces((t or "").lower() for t in texts):
            raw = np.frombuffer(buf, np.uint8)
            starts, ends = spans(buf, ALNUM)
            hashes = word_hashes(buf, starts, ends)
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[at] == hashes
            hot = np.flatnonzero(hit & self.hot[at])
            if not len(hot):
                continue
            known = np.flatnonzero(hit)
            stops = np.flatnonzero(_STOP[raw])
            clause_of = np.searchsorted(stops, starts[known])
            for clause in np.unique(np.searchsorted(stops, starts[hot])).tolist():
                a, b = np.searchsorted(clause_of, [clause, clause + 1])
                doc = first + int(np.searchsorted(begins, starts[known[a]], "right")) - 1
                self._run(known[a:b].tolist(), at, out[doc])
        return out

    def _run(self, known: list[int], at: np.ndarray, into: np.ndarray) -> None:
        state, weight, before = self.start, 1.0, None
        for i in [*known, None]:
            # Unknown words only move the machine on: more than REACH of them change nothing more.
            for _ in range(min(REACH, i - before - 1) if i is not None and before is not None else 0):
                state, written = self.machine[state, "other"]
                self._count(written, weight, into)
            before = i
            kind = "end" if i is None else self.classes[at[i]]
            if kind in HOT:
                weight = self.weights[at[i]]
            state, written = self.machine[state, kind]
            self._count(written, weight, into)
        into[-1] += 1

    @staticmethod
    def _count(written: tuple[str, ...], weight: float, into: np.ndarray) -> None:
        for x in written:
            if x in _OUT:
                into[_OUT[x]] += weight


_OUT = {x: i for i, x in enumerate(OUT)}
#: Where clauses end: stops, bars and line ends.
_STOP = np.zeros(256, bool)
_STOP[list(b".!?;|\n")] = True


def _x(clauses: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(clauses)), np.log1p(clauses), (clauses[:, :MATCHES].sum(1) > 0)])


#: Used where there are no labels to learn from: one direct match is enough.
FIXED = np.array([-2.0, 1, 1, -0.5, -0.5, 1, 2.5, -0.5, -0.5, 0, 0, 0, 2])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Scorer, np.ndarray]:
    chosen = written(labelled_sample(docs, labels, "toxic", ~held_out(FOLDS, HELD_OUT), sample), "labelled-sample")
    scorer = Scorer(induce(chosen))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(list(scorer.clauses(batch.column(1).to_pylist())), pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    found = sorted(chosen.select("doc_id", "text", "label").mapInArrow(rows, "doc_id long, label int, x array<double>").collect())
    y = np.array([r.label for r in found])
    if len(set(y.tolist())) < 2:
        return scorer, FIXED
    return scorer, logistic(_x(np.array([r.x for r in found])), y, L2, prior=FIXED)


def score_toxicity(docs: DataFrame, model: tuple[Scorer, np.ndarray]) -> DataFrame:
    """doc_id, held_out, score, predicted, clauses (how many matched) of each document."""
    scorer, w = model

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scorer.clauses(batch.column(2).to_pylist())
            s = sigmoid(_x(found) @ w)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= CUT).astype(np.int32)), pa.array(found[:, -1].astype(np.int64))],
                names=["doc_id", "held_out", "score", "predicted", "clauses"],
            )

    picked = docs.select(F.col("doc_id").cast("long"), held_out(FOLDS, HELD_OUT).alias("held_out"), "text")
    return picked.mapInArrow(rows, "doc_id long, held_out boolean, score double, predicted int, clauses long")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
