"""Language-model scores with a weighted backoff automaton.

Counts come from all training texts. An n-gram is kept if it occurs twice, at any input size; every word is kept.
In the automaton of the kept n-grams a state is a context of up to two tokens, an arc a kept n-gram with its
discounted probability, and a failure arc leads to the context without its first token, with the backoff weight that
makes probabilities add up to one. At the root every word counts with its additively smoothed unigram probability.
Every text is walked once from left to right: the walk carries the state, takes the arc of the next token or failure
arcs until there is one, and adds up their logarithms.

The automaton grows with the input and is never in one place. Documents are dealt to portions of bounded text, n-gram
hashes (64 bits) to ranges. A portion sends each of its distinct n-grams once, with its count, and is told which are
kept, with their total; so an n-gram that is everywhere arrives once per portion. Words and pairs go first, triples
only where both of their pairs are kept. Each kept n-gram has one owning portion, which adds its probability to its
context; the contexts' sums, again by range, give the failure weights, and every portion gets those of its own
contexts. Then it holds the part of the automaton that its texts can reach, and walks them. What is sent is packed as
sorted, delta-coded hashes; what is answered is a bit and a number per hash sent, in the same order.

Null and empty texts are the end token alone. Repeated rows are counted and scored each; rows that repeat id and text
are held once with their number. A null id is scored like any other. Without any training token the unknown word has
all the probability, so every score is 0. A very long text is a portion of its own, in memory of about a hundred bytes
for each of its tokens. An empty table gives no rows. Extra columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from meterline.llm.packs import as_table, cuts, dealt, packed_planes, steps, unpacked_bits, unpacked_planes
from meterline.llm.storage import forget, release, stored
from meterline.llm.textbytes import U, Words, chunks, mix, text_bytes

ORDER = 3
DISCOUNT = 0.5
ADDED = 0.1  # to every count at the root
END = -0x5851F42D4C957F2D  # stands for the end of a text among the word hashes
PORTION = 8 << 20  # bytes of text per portion
STRETCH = 1024  # tokens walked on end
RANGE = 24 << 20  # bytes of text whose n-grams one range adds up
_STEP = U(0x9E3779B97F4A7C15)


def tokens(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Token hashes of some rows on end, each row closed by the end token, and where rows begin."""
    data, offsets = text_bytes(column)
    for i, j in chunks(offsets):
        words = Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        first = words.first + np.arange(j - i + 1)
        out = np.full(int(first[-1]), END, np.int64)
        out[np.arange(len(words.hash)) + words.row] = words.hash.view(np.int64)
        yield out, first


def gram_keys(word: np.ndarray, first: np.ndarray, orders: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order the hash of the n-gram that ends at each token, and each token's place in its row."""
    keys = [word.view(np.uint64)]
    for k in range(2, orders + 1):
        key = np.zeros(len(word), np.uint64)
        key[1:] = mix(keys[-1][:-1] * _STEP + keys[0][1:] + U(k))
        keys.append(key)
    return keys, np.arange(len(word)) - np.repeat(first[:-1], np.diff(first))


class Distinct:
    """The distinct n-grams of one order among a portion's tokens, in the order of their hashes.

    ``of`` is the number among them of the n-gram that ends at each token, or their count where none does.
    """

    def __init__(self, keys: np.ndarray, fit: np.ndarray):
        self.at = np.flatnonzero(fit)
        self.keys, self.head, which = np.unique(keys[self.at], return_index=True, return_inverse=True)
        self.head = self.at[self.head]  # a token at which each ends
        self.of = np.full(len(keys), len(self.keys))
        self.of[self.at] = which

    def counted(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.of[self.at], weights=weight[self.at], minlength=len(self.keys)).astype(np.uint64)


_SENT = "part int, portion int, ord int, n int, keys binary, numbers binary"
_KEPT = "portion int, part int, ord int, n int, kept binary, owned binary, numbers binary, total long, kinds long"


def _sent(name: int, ranges: int, keys: list[tuple[int, np.ndarray, list[np.ndarray]]]) -> pa.Table:
    """Rising hashes of some orders with numbers of each, by range. An order below zero is that of contexts."""
    out = {c: [] for c in ("part", "portion", "ord", "n", "keys", "numbers")}
    for order, key, numbers in keys:
        part, _ = dealt(key, ranges)
        for a, b in cuts(part):
            for c, value in zip(out, (int(part[a]), name, order, b - a, packed_planes([steps(key[a:b])]), packed_planes([x[a:b] for x in numbers]))):
                out[c].append(value)
    return as_table(_SENT, **out)


def _received(group: pa.Table) -> Iterator[tuple[int, list[int], np.ndarray, np.ndarray, list[np.ndarray]]]:
    """By order: its rows in the group, where each one's hashes end, all hashes, and the numbers with them."""
    given = group.to_pydict()
    for order in sorted(set(given["ord"])):
        types = ["u8"] if order > 0 else ["f8", "f8"]
        rows = [i for i, o in enumerate(given["ord"]) if o == order]
        keys = [np.cumsum(unpacked_planes(given["keys"][i], given["n"][i], ["u8"])[0], dtype=np.uint64) for i in rows]
        numbers = [unpacked_planes(given["numbers"][i], given["n"][i], types) for i in rows]
        yield order, rows, np.cumsum([len(k) for k in keys]), np.concatenate(keys), [np.concatenate(c) for c in zip(*numbers)]


def _answered(group: pa.Table) -> pa.Table:
    """What a range tells each portion of the hashes it sent, and the words of the range.

    Of n-grams: which are kept, their totals, and which of those it owns. Of contexts: which have arcs, and their
    failure weights.
    """
    out = {c.split()[0]: [] for c in _KEPT.split(", ")}

    def tell(*values):
        for c, x in zip(out, values):
            out[c].append(x)

    for order, rows, ends, keys, numbers in _received(group):
        value, head, which = np.unique(keys, return_index=True, return_inverse=True)
        sums = [np.bincount(which, weights=x, minlength=len(value)) for x in numbers]
        if order > 0:
            known, number = sums[0] >= (1 if order == 1 else 2), sums[0].astype(np.uint64)
        else:
            known, number = sums[0] > 0, np.log10(np.maximum(1 - sums[0], 1e-12) / np.maximum(1 - sums[1], 1e-12))
        own = np.zeros(len(keys), bool)
        own[head] = order > 0
        for i, a, b in zip(rows, [0, *ends.tolist()], ends.tolist()):
            here = which[a:b]
            mine = known[here]
            tell(group["portion"][i].as_py(), group["part"][i].as_py(), order, b - a, np.packbits(mine).tobytes(),
                 np.packbits(own[a:b][mine]).tobytes(), packed_planes([number[here][mine]]), None, None)
        if order == 1:
            tell(-1, 0, 0, 0, b"", b"", b"", int(sums[0].sum()), int((sums[0] > 0).sum()))
    return as_table(_KEPT, **out)


def _answer(answers: pa.Table, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the hashes a portion sent of an order: whether kept, the numbers of those kept, and whether owned."""
    kind = "u8" if order > 0 else "f8"
    given = answers.to_pydict()
    rows = sorted((i for i, o in enumerate(given["ord"]) if o == order), key=lambda i: given["part"][i])
    none = np.zeros(0, bool)
    kept = [unpacked_bits(given["kept"][i], given["n"][i]) for i in rows]
    numbers = [unpacked_planes(given["numbers"][i], int(k.sum()), [kind])[0] for i, k in zip(rows, kept)]
    owned = [unpacked_bits(given["owned"][i], int(k.sum())) for i, k in zip(rows, kept)]
    return tuple(np.concatenate([empty, *x]) for empty, x in ((none, kept), (np.zeros(0, "<" + kind), numbers), (none, owned)))


class Portion:
    """A portion's tokens, its distinct n-grams, and what it was told of them."""

    def __init__(self, rows: pa.Table, answers: pa.Table | None, orders: int):
        held = list(tokens(rows.column("text")))
        lengths = np.concatenate([np.zeros(0, np.int64), *(np.diff(first) for _, first in held)])
        self.first = np.concatenate([[0], np.cumsum(lengths)])
        word = np.concatenate([np.zeros(0, np.int64), *(found for found, _ in held)])
        self.keys, self.place = gram_keys(word, self.first, orders)
        self.row = np.repeat(np.arange(len(lengths)), lengths)
        self.weight = np.where(rows.column("train").to_numpy(), rows.column("copies").to_numpy(), 0)[self.row]
        self.grams, self.total, self.owned = [], [], []
        for order in range(1, orders + 1):
            if order > 2:
                if not self._learnt(order - 1):
                    break
                pairs = self.total[-1][self.grams[-1].of] > 0
                fit = (self.place >= order - 1) & pairs & np.concatenate([[False], pairs[:-1]])
            else:
                fit = self.place >= order - 1
            self.grams.append(Distinct(self.keys[order - 1], fit))
            if answers is not None:
                kept, numbers, owned = _answer(answers, order)
                if len(kept) == len(self.grams[-1].keys):
                    total, own = np.zeros(len(kept) + 1), np.zeros(len(kept), bool)  # the last stands for no n-gram
                    total[:-1][kept] = numbers
                    own[kept] = owned
                    self.total.append(total)
                    self.owned.append(own)

    def _learnt(self, order: int) -> bool:
        return len(self.total) >= order

    def totals(self, order: int) -> np.ndarray:
        """How often the n-gram that ends at each token occurs in all, 0 if it is not kept."""
        return self.total[order - 1][self.grams[order - 1].of]


    def arcs_of_contexts(self, c: int, total: int, kinds: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """The kept contexts of c tokens, with the probabilities of the arcs owned here, above and below the failure arc."""
        here, context = self.grams[c], self.grams[c - 1]
        n, of = self.totals(c + 1), self.totals(c)
        at = here.head[self.owned[c] & (self.total[c][:-1] > 0)]  # each owned arc, at one of its tokens
        above = (n[at] - DISCOUNT) / of[at - 1]
        below = 10 ** _root(of[at], total, kinds) if c == 1 else (of[at] - DISCOUNT) / self.totals(c - 1)[at - 1]
        kept = self.total[c - 1][:-1] > 0
        return context.keys[kept], [np.bincount(context.of[at - 1], weights=x, minlength=len(kept) + 1)[:-1][kept] for x in (above, below)]


def _send(counts: tuple[int, ...], contexts: tuple[int, ...], ranges: int, total: int = 0, kinds: int = 0):
    """A portion's distinct n-grams of the orders ``counts`` and its contexts of the lengths ``contexts``."""
    def send(rows: pa.Table, answers: pa.Table | None) -> pa.Table:
        if not rows.num_rows:
            return _sent(0, ranges, [])
        portion = Portion(rows, answers, max([*counts, *(c + 1 for c in contexts)]))
        out = [(k, portion.grams[k - 1].keys, [portion.grams[k - 1].counted(portion.weight)]) for k in counts if k <= len(portion.grams)]
        out += [(-c, *portion.arcs_of_contexts(c, total, kinds)) for c in contexts if c < len(portion.total)]
        return _sent(rows.column("portion")[0].as_py(), ranges, out)

    def first(rows: pa.Table) -> pa.Table:
        return send(rows, None)

    def later(rows: pa.Table, answers: pa.Table) -> pa.Table:
        return send(rows, answers)
    return later if contexts else first


def _root(n: np.ndarray, total: int, kinds: int) -> np.ndarray:
    return np.log10((n + ADDED) / (total + ADDED * (kinds + 1)))


def walk(first: np.ndarray, arcs: list[np.ndarray], fails: list[np.ndarray], states: list[np.ndarray]) -> np.ndarray:
    """The log probability of every text, walked from left to right.

    ``arcs[k]`` is the logarithm of the arc of the token after a context of k tokens, NaN where there is none, but
    always there for the root; ``fails[k]`` the failure weight of each context of k + 1 tokens, and 0 as its last;
    ``states[k]`` the context of k + 1 tokens that ends at each token, or the last. All texts advance together; a
    text goes on in stretches, each of which begins in the state that the token before it left.
    """
    length = np.diff(first)
    pieces = -(-length // STRETCH)
    nth = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(first[:-1], pieces) + nth * STRETCH
    size = np.minimum(np.repeat(first[1:], pieces) - begin, STRETCH)
    order = np.argsort(-size, kind="stable")  # those with a next token are the first ones
    at, left = begin[order], -size[order]
    fresh = nth[order] == 0  # at the root there is no context
    state = [np.where(fresh, len(f) - 1, s[np.maximum(at - 1, 0)]) for f, s in zip(fails, states)]
    score = np.zeros(len(at))
    for t in range(int(size.max(initial=0))):
        m = int(np.searchsorted(left, -t, "left"))
        here = at[:m] + t
        step = arcs[0][here]
        for k, fail in enumerate(fails):
            arc = arcs[k + 1][here]
            step = np.where(np.isnan(arc), fail[state[k][:m]] + step, arc)
        score[:m] += step
        state = [s[here] for s in states]
    out = np.empty(len(score))
    out[order] = score
    return np.add.reduceat(out, np.cumsum(pieces) - pieces) if len(length) else out


def _walked(orders: int, total: int, kinds: int, kind: pa.DataType):
    names = ["doc_id", "copies", "n_tokens", "n_known", "base_score", "score"]

    def run(rows: pa.Table, told: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table([pa.array([], t) for t in (kind, *[pa.int64()] * 3, *[pa.float64()] * 2)], names=names)
        portion = Portion(rows, told, orders)
        count = [portion.totals(k) for k in range(1, len(portion.total) + 1)]
        root = _root(count[0], total, kinds)
        arcs, fails, states = [root], [], []
        for k in range(2, len(count) + 1):
            known = np.flatnonzero(count[k - 1] > 0)
            arc = np.full(len(root), np.nan)
            arc[known] = np.log10((count[k - 1][known] - DISCOUNT) / count[k - 2][known - 1])
            arcs.append(arc)
            context = portion.grams[k - 2]
            kept, number, _ = _answer(told, 1 - k)
            sent = np.flatnonzero(portion.total[k - 2][:-1] > 0)
            fail = np.zeros(len(context.keys) + 1)
            fail[sent[kept]] = number
            fails.append(fail)
            states.append(context.of)
        n = np.diff(portion.first)
        sums = lambda x: np.add.reduceat(x, portion.first[:-1])  # every text has a token
        return pa.table([rows.column("doc_id"), rows.column("copies"), pa.array(n), pa.array(sums((count[0] > 0).astype(np.int64))),
                         pa.array(sums(root)), pa.array(walk(portion.first, arcs, fails, states))], names=names)
    return run


def score(docs: DataFrame, training, orders: int = ORDER) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text); ``training`` is the condition on doc_id of those to learn from.

    Returns doc_id, n_tokens, n_known, train_tokens, base_score, score.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    portions, ranges = 1 + size // PORTION, 1 + size // RANGE
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.coalesce(training, F.lit(False)).alias("train"))
    rows = rows.withColumns({"hash": F.xxhash64("text"), "portion": F.pmod(F.xxhash64("doc_id", "text"), F.lit(portions)).cast("int")})
    rows = (rows.repartition("portion").groupBy("portion", "doc_id", "hash")
            .agg(F.first("text").alias("text"), F.first("train").alias("train"), F.count("*").alias("copies")).drop("hash"))
    learning = rows.select("portion", "text", "train", "copies").groupBy("portion")

    def answered(sent: DataFrame, name: str) -> DataFrame:
        out = stored(sent.groupBy("part").applyInArrow(_answered, _KEPT), name)
        release(spark)
        return out

    tables = [answered(learning.applyInArrow(_send((1, 2)[:orders], (), ranges), _SENT), "kept-1")]
    words = tables[0].agg(F.sum("total").alias("total"), F.sum("kinds").alias("kinds")).first()
    total, kinds = words["total"] or 0, words["kinds"] or 0
    told = tables[0].where("portion >= 0")
    for k in range(3, orders + 2):  # contexts follow as soon as their arcs are known
        counts, contexts = ((k,), (k - 2,)) if k <= orders else ((), (orders - 1,))
        sent = learning.cogroup(told.groupBy("portion")).applyInArrow(_send(counts, contexts, ranges, total, kinds), _SENT)
        tables.append(answered(sent, f"kept-{k}"))
        told = told.unionByName(tables[-1].where("portion >= 0"))
    kind = dict(docs.dtypes)["doc_id"]
    walked = rows.groupBy("portion").cogroup(told.groupBy("portion")).applyInArrow(
        _walked(orders, total, kinds, to_arrow_type(docs.schema["doc_id"].dataType)),
        f"doc_id {kind}, copies long, n_tokens long, n_known long, base_score double, score double")
    scored = stored(walked, "scored")
    for table in tables:
        forget(table)
    release(spark)
    return (scored.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select("doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"))
