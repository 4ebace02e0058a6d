"""Language-model scoring by a log-bilinear model trained with noise-contrastive estimation.

Outputs are the ``FREQUENT`` commonest words and ``GROUPS`` groups of the others (by a hash of the first two bytes); a word
of a group has the group's probability times its add-one share of the group's training tokens, an unseen word the
share of one, so the probabilities of all words sum to one. The two words before are the context: each maps to one of the
``NAMED`` commonest words or of ``LOOSE`` groups, and a position-dependent vector of each predicts the output's vector by their
product (log-bilinear). There are few contexts, so all their normalisers are exact: a batched matrix product over
contexts and outputs.

Counts cover every training document (combined before the shuffle). Training does too: in each of ``ROUNDS`` rounds every task
runs stochastic gradient descent on its share of the round's documents from the common parameters, and the parameters are averaged by
tokens as an aggregation; only averages, whose size is fixed, reach the driver. Counts of at most ``HOT`` words are broadcast;
tokens of rarer words are summed by document and joined with the count table.

Defined cases: a null text is empty and has one token, the end; without training documents all counts are 0 and the scores
follow from that; repeated rows are scored alike, each as a row of its own; a null id is never held out; other columns do not matter.
Words are known by 64-bit hashes.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skyledger.llm.shared import settled
from skyledger.llm.texts import SPACES, U, Words, blocks

FREQUENT, GROUPS = 3072, 512
NAMED, LOOSE = 192, 64
DIM, BATCH, ROUNDS = 16, 4096, 3
#: Step size of each round.
RATES = (0.07, 0.05, 0.03)
#: Noise terms per token in expectation; outputs that stand for them in a batch.
NOISE, ALWAYS, DRAWN = 64, 128, 384
HOT = 1 << 19
#: Stands for the end of a text among word hashes.
END = np.int64(0x0E4D0F7E57)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and group of every token of a block, each row's words followed by its end, and the rows' edges."""
    w = Words(column, SPACES, lower=True)
    n = len(w.counts)
    edges = np.concatenate([[0], np.cumsum(w.counts + 1)])
    at = np.arange(len(w)) + w.row
    h = np.full(edges[-1], END, np.int64)
    h[at] = w.hashes().view(np.int64)
    group = np.zeros(edges[-1], np.int32)
    group[at] = (w.hashes(0, upto=2) % U(GROUPS)).astype(np.int32)
    return h, group, edges


def counted(docs: DataFrame, text: str) -> DataFrame:
    """(h, part, n): training count of every token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                h, group, _ = tokens(part.column("text"))
                values, first, n = np.unique(h, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(group[first]), pa.array(n.astype(np.int64))], ["h", "part", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "h bigint, part int, n bigint")
    return rows.groupBy("h", "part").agg(F.sum("n").alias("n"))


@dataclasses.dataclass
class Vocabulary:
    """The commonest words by rising hash, with their counts, outputs (-1: in a group) and context classes (-1: in a group)."""

    h: np.ndarray
    n: np.ndarray
    output: np.ndarray
    context: np.ndarray
    group_total: np.ndarray
    output_count: np.ndarray
    total: int
    distinct: int
    rare_below: int

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 where it is not held."""
        if not len(self.h):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return np.where(self.h[at] == h, at, -1)

    def ids(self, h: np.ndarray, group: np.ndarray, edges: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Output of each token, and the classes of the word before it and the one before that."""
        at = self.look_up(h) if at is None else at
        output = np.where(at >= 0, self.output[at] if len(self.h) else -1, -1)
        output = np.where(output >= 0, output, FREQUENT + group)
        own = np.where(at >= 0, self.context[at] if len(self.h) else -1, -1)
        own = np.where(own >= 0, own, NAMED + group % LOOSE)
        before = NAMED + LOOSE  # the begin of a text
        one, two = np.full(len(h), before), np.full(len(h), before)
        one[1:], two[2:] = own[:-1], own[:-2]
        begins = edges[:-1]
        one[begins] = two[begins] = before
        second = begins[np.diff(edges) > 1] + 1
        two[second] = before
        return output, one, two

    def context_share(self) -> np.ndarray:
        """About how often each context class is used, by the training counts."""
        out = np.zeros(CONTEXTS)
        named = self.context >= 0
        out[self.context[named]] = self.n[named]
        rest = max(0, self.total - int(self.n[named].sum()))
        out[NAMED : NAMED + LOOSE] = rest / LOOSE
        return out / max(1, self.total)

    def trimmed(self) -> Vocabulary:
        """Only the words that training needs."""
        keep = (self.output >= 0) | (self.context >= 0)
        return dataclasses.replace(self, h=self.h[keep], n=self.n[keep], output=self.output[keep], context=self.context[keep])


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the count table; what reaches the driver is at most ``HOT`` words and ``GROUPS`` sums."""
    steps = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens"))
    # One row per distinct count; a table of words has fewer of these than the square root of twice its tokens.
    ranked = steps.withColumn("above", F.sum("words").over(W.orderBy(F.desc("n"))))
    sums = ranked.agg(F.sum("tokens"), F.sum("words"), F.min(F.when(F.col("above") <= HOT, F.col("n")))).first()
    total, distinct, least = (x or 0 for x in sums)
    hot = counts.where(F.col("n") >= F.lit(least)).toArrow() if least else counts.limit(0).toArrow()
    hot = hot.sort_by([("n", "descending"), ("h", "ascending")])
    h, n = hot["h"].to_numpy(), hot["n"].to_numpy()
    place = np.arange(len(h))
    # The end of a text always has an output of its own, the last one.
    word = h != END
    rank = np.cumsum(word) - 1
    output = np.where(word, np.where(rank < FREQUENT - 1, rank, -1), FREQUENT - 1)
    context = np.where(word & (rank < NAMED), rank, -1)
    grouped = counts.groupBy("part").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).toArrow()
    group_n, group_words = np.zeros(GROUPS), np.zeros(GROUPS)
    group_n[grouped["part"].to_numpy()] = grouped["n"].to_numpy()
    group_words[grouped["part"].to_numpy()] = grouped["words"].to_numpy()
    named = output >= 0
    parts = hot["part"].to_numpy()
    np.add.at(group_n, parts[named], -n[named])
    np.add.at(group_words, parts[named], -1)
    output_count = np.zeros(FREQUENT + GROUPS)
    output_count[output[named]] = n[named]
    output_count[FREQUENT:] = group_n
    order = np.argsort(h)
    return Vocabulary(
        h[order], n[order], output[order], context[order], group_n + group_words + 1, output_count, int(total), int(distinct), int(least) if len(place) else 0
    )


OUTPUTS, CONTEXTS = FREQUENT + GROUPS, NAMED + LOOSE + 1


def first_parameters(output_count: np.ndarray) -> np.ndarray:
    """Rows of outputs (vector and bias), then of contexts one back and two back (vector)."""
    rng = np.random.default_rng(13)
    out = rng.normal(0, 0.3, (OUTPUTS + 2 * CONTEXTS, DIM + 1)).astype(np.float32)
    out[:OUTPUTS, DIM] = np.log((output_count + 1) / (output_count + 1).sum())
    out[OUTPUTS:, DIM] = 0
    return out


def _summed(ids: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(ids, rows[:, k], n) for k in range(rows.shape[1])], axis=1)


def contrast(share: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Noise outputs of a batch and their weights: the commonest always, the others drawn evenly and weighed up.

    A noise term counts ``NOISE`` times its share of the noise in expectation, as if drawn from the noise distribution.
    """
    order = np.argsort(-share, kind="stable")
    always, rest = order[:ALWAYS], order[ALWAYS:]
    drawn = rng.choice(rest, DRAWN, replace=False)
    return np.concatenate([always, drawn]), NOISE * np.concatenate([share[always], share[drawn] * (len(rest) / DRAWN)])


def descend(theta: np.ndarray, scale: np.ndarray, share: np.ndarray, output: np.ndarray, one: np.ndarray, two: np.ndarray, rate: float, rng: np.random.Generator) -> None:
    """One step of noise-contrastive estimation on a batch, in place; the noise outputs are common to the batch.

    ``scale``: expected uses of each row in a batch, by which its gradient is divided.
    """
    drawn, weight = contrast(share, rng)
    shift = np.log(NOISE * share).astype(np.float32)
    predicted = theta[OUTPUTS + one, :DIM] + theta[OUTPUTS + CONTEXTS + two, :DIM]
    target = theta[output]
    real = np.einsum("bd,bd->b", predicted, target[:, :DIM]) + target[:, DIM] - shift[output]
    miss = 1 / (1 + np.exp(np.clip(real, -30, 30)))
    # The noise part is taken on the first quarter of the (shuffled) batch and weighed up: there the outputs matter more than
    # the contexts. Weight times the probability of taking noise for a word is weight / (1 + exp(-score)).
    n = -(-len(output) // 4)
    few = predicted[:n]
    fake = few @ -theta[drawn, :DIM].T
    fake += shift[drawn] - theta[drawn, DIM]
    with np.errstate(over="ignore"):
        np.exp(fake, out=fake)
    fake += 1
    np.divide((weight * (len(output) / n)).astype(np.float32), fake, out=fake)
    back = -miss[:, None] * target[:, :DIM]
    back[:n] += fake @ theta[drawn, :DIM]
    slope = np.zeros_like(theta)
    slope[:OUTPUTS] = -_summed(output, np.concatenate([miss[:, None] * predicted, miss[:, None]], axis=1), OUTPUTS)
    slope[drawn] += np.concatenate([fake.T @ few, fake.sum(axis=0)[:, None]], axis=1)
    slope[OUTPUTS : OUTPUTS + CONTEXTS, :DIM] = _summed(one, back, CONTEXTS)
    slope[OUTPUTS + CONTEXTS :, :DIM] = _summed(two, back, CONTEXTS)
    theta -= np.float32(rate) * slope / scale


def trained(docs: DataFrame, text: str, words: Vocabulary) -> np.ndarray:
    """Parameters after ``ROUNDS`` rounds; each round trains on the documents of one remainder of a hash of their text."""
    theta = first_parameters(words.output_count)
    share = (words.output_count + 1) / (words.output_count + 1).sum()
    fields = [f"x{k}" for k in range(DIM + 1)]
    for turn in range(ROUNDS):
        shared = docs.sparkSession.sparkContext.broadcast((vars(words.trimmed()), theta, share))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, start, share = shared.value
            vocabulary, theta = Vocabulary(**held), start.astype(np.float32)
            uses, rng, seen = vocabulary.context_share(), np.random.default_rng(turn), 0
            scale = (BATCH * np.concatenate([share, uses, uses]) + 1)[:, None].astype(np.float32)
            for batch in batches:
                for part in blocks(batch):
                    output, one, two = vocabulary.ids(*tokens(part.column("text")))
                    order = rng.permutation(len(output))
                    for a in range(0, len(order), BATCH):
                        some = order[a : a + BATCH]
                        descend(theta, scale, share, output[some], one[some], two[some], RATES[turn] * len(some) / BATCH, rng)
                    seen += len(order)
            if seen:
                columns = [pa.array(np.arange(len(theta), dtype=np.int32)), pa.array(np.full(len(theta), float(seen)))]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(theta[:, k].astype(float)) for k in range(DIM + 1)]], ["row", "seen", *fields])

        part = docs.where(F.pmod(F.xxhash64(F.lit("round"), text), F.lit(ROUNDS)) == turn).select(F.col(text).alias("text"))
        local = part.mapInArrow(learn, "row int, seen double, " + ", ".join(f"{x} double" for x in fields))
        mean = local.groupBy("row").agg(*[(F.sum(F.col(x) * F.col("seen")) / F.sum("seen")).alias(x) for x in fields]).toArrow()
        if mean.num_rows:
            theta = np.empty(theta.shape)
            theta[mean["row"].to_numpy()] = np.stack([mean[x].to_numpy() for x in fields], axis=1)
    return theta


@dataclasses.dataclass
class Scorer:
    """Tables of the trained model: a token's log-probability is two products, a bias and a normaliser."""

    one: np.ndarray
    two: np.ndarray
    bias: np.ndarray
    normaliser: np.ndarray

    @classmethod
    def of(cls, theta: np.ndarray) -> Scorer:
        out, bias = theta[:OUTPUTS, :DIM], theta[:OUTPUTS, DIM]
        a, b = theta[OUTPUTS : OUTPUTS + CONTEXTS, :DIM], theta[OUTPUTS + CONTEXTS :, :DIM]
        norm = np.empty((CONTEXTS, CONTEXTS))
        for i in range(CONTEXTS):  # all contexts that share the word before: one product
            z = (a[i] + b) @ out.T + bias
            top = z.max(axis=1)
            norm[i] = top + np.log(np.exp(z - top[:, None]).sum(axis=1))
        return cls((a @ out.T).astype(np.float32), (b @ out.T).astype(np.float32), bias, norm)

    def log_probability(self, output: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.one[one, output].astype(float) + self.two[two, output] + self.bias[output] - self.normaliser[one, two]


def scored(docs: DataFrame, learn_from: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``."""
    counts = settled(counted(learn_from, text))
    words = vocabulary(counts)
    scorer = Scorer.of(trained(learn_from, text, words))
    shared = docs.sparkSession.sparkContext.broadcast((vars(words), vars(scorer)))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tables = shared.value
        vocabulary, scorer = Vocabulary(**held), Scorer(**tables)
        for batch in batches:
            for part in blocks(batch):
                h, group, edges = tokens(part.column("text"))
                at = vocabulary.look_up(h)
                output, one, two = vocabulary.ids(h, group, edges, at)
                known = at >= 0
                log_count = np.zeros(len(h))
                if len(vocabulary.h):
                    log_count[known] = np.log10(vocabulary.n[at[known]] + 1.0)
                grouped = output >= FREQUENT
                model = scorer.log_probability(output, one, two) / np.log(10)
                model[grouped] += log_count[grouped] - np.log10(vocabulary.group_total[output[grouped] - FREQUENT])
                begins = edges[:-1]
                rare = np.flatnonzero(~known)
                row = np.searchsorted(edges, rare, "right") - 1
                order = np.lexsort((h[rare], row))
                r, v = row[order], h[rare][order]
                new = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (v[1:] != v[:-1])][: len(r)])
                times = np.diff(np.r_[new, len(r)])
                ends = np.searchsorted(r[new], np.arange(len(begins) + 1)).astype(np.int32)
                pairs = pa.StructArray.from_arrays([pa.array(v[new]), pa.array(times.astype(np.int64))], ["h", "times"])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("own"), part.column("row"), pa.array(np.diff(edges).astype(np.int64)), pa.array(np.add.reduceat(known, begins, dtype=np.int64)),
                        pa.array(np.add.reduceat(log_count, begins)), pa.array(np.add.reduceat(model, begins)), pa.ListArray.from_arrays(pa.array(ends), pairs),
                    ],
                    ["own", "row", "n_tokens", "known", "base", "model", "rare"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("own"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    first = settled(
        rows.mapInArrow(judge, f"own {kind}, row bigint, n_tokens bigint, known bigint, base double, model double, rare array<struct<h:bigint,times:bigint>>")
    )
    seldom = counts.where(F.col("n") < F.lit(max(words.rare_below, 1)) if words.rare_below else F.lit(True)).select("h", "n")
    rest = (
        first.select("row", F.explode("rare").alias("r")).select("row", "r.*").join(seldom, "h")
        .groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("times").alias("seen"))
    )
    more, seen = F.coalesce("more", F.lit(0.0)), F.coalesce("seen", F.lit(0).cast("long"))
    floor = float(np.log10(words.total + words.distinct + 1))
    return first.drop("rare").join(rest, "row", "left").select(
        F.col("own").alias(doc_id), "n_tokens", (F.col("known") + seen).alias("n_known"), F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * floor).alias("base_score"), (F.col("model") + more).alias("score"),
    )
