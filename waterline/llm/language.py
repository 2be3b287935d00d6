"""Scores of texts by a hierarchical Pitman-Yor model of words in context.

Restaurants stand above one another: one for each context of a word, which is the whole word before it
(at a text's beginning the end of a text); one of all words, the parent all contexts share;
restaurants of the next byte of a word's spelling after two bytes and after one, again with shared
parents; one of all bytes above a uniform choice. Customers of a context are the words of the training
texts; each table sends one customer to the parent. Seatings are sampled by Gibbs: a turn draws the
tables of every dish given the rest, then strengths and discounts given all tables. What a word costs in
a context is averaged over the last turns.

Texts are read once, in chunks. Words meet in parts, pairs of a word and the one before it in buckets.
Pairs with one customer have one table whatever is drawn, so only the others are seated anew. In a turn,
buckets tell parts how many tables their pairs have, and parts answer with the restaurants' totals and
the words' probabilities, drawn as well: given those, all pairs are independent of one another.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.llm.tables import prepare
from waterline.sources.staging import materialise, release

# Tokens of a chunk at least, unless its task has no more.
CHUNK_TOKENS = 1 << 21
# In spelling: beyond a word's ends.
END = 256
SYMBOLS = 257
# Turns of the chain, of which the last ones count as samples; turns of the spelling within one.
TURNS_OF_ALL, SAMPLES, TURNS = 4, 2, 5
STRENGTH, BYTE_DISCOUNT = 1.0, 0.5
# Customers up to which the number of tables is drawn from the exact distribution.
EXACT = 256
# Smaller logarithms of a spelling's probability count as this one.
LEAST_LOG = -600.0
# Numbers drawn at once: dishes, each with a row of up to EXACT.
DRAWN_AT_ONCE = 1 << 19
# So many tables of others that a dish's own make no difference.
MANY = 1e12
# Spark then deletes shuffle files when the query that made them ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Rows between the steps: what they are, the chunk or bucket and the part or bucket they are of, and packed columns.
BLOCKS = (
    "kind int, chunk long, part long, a binary, b binary, c binary, d binary, e binary, "
    "ids array<string>, held array<boolean>, keys array<long>, sums array<double>"
)
_ASKED, _WORDS, _BLOCK, _TEXT, _STATE, _SAID, _REPLY, _SUMS, _TOLD_WORDS, _TOLD_PAIRS = range(10)
_BLOCK_TYPES = pa.schema(
    [
        ("kind", pa.int32()), ("chunk", pa.int64()), ("part", pa.int64()), *[(c, pa.binary()) for c in "abcde"],
        ("ids", pa.list_(pa.string())), ("held", pa.list_(pa.bool_())), ("keys", pa.list_(pa.int64())), ("sums", pa.list_(pa.float64())),
    ]
)
SCORES = "word binary, known long, word_contexts array<int>, word_scores array<double>"
_SCORE_TYPES = pa.schema([("word", pa.binary()), ("known", pa.int64()), ("word_contexts", pa.list_(pa.int32())), ("word_scores", pa.list_(pa.float64()))])
SUMS = "id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """Numbers between 0 and 1 that depend on keys and salt alone."""
    x = keys.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53


def log_stirling(discount: float, most: int = EXACT) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: ways to seat c customers at t tables."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(most):
        more = np.append(np.log(c - discount * np.arange(1, c + 1)), 0.0)
        out[c + 1, 1 : c + 2] = np.logaddexp(out[c, : c + 1], out[c, 1 : c + 2] + more)
    return out


def draw_tables(customers, log_base, others, discount, strength, stirling, keys, salt) -> np.ndarray:
    """Numbers of tables of dishes, given the parent's probabilities and the other tables of their restaurants.

    Without ``others`` each table weighs as much as the first, ``exp(log_base)``. Up to ``EXACT`` customers
    the draw is from the exact distribution, beyond from its limit.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    low = 2
    for width in (2, 4, 8, 32, EXACT):
        rows = np.flatnonzero((customers >= low) & (customers <= width))
        low, step, t = width + 1, DRAWN_AT_ONCE // width, np.arange(width)
        for start in range(0, len(rows), step):
            these = rows[start : start + step]
            if others is None:
                opened = log_base[these, None] * (t + 1)
            else:
                opened = np.cumsum(np.log(strength + discount * (others[these, None] + t)) + log_base[these, None], axis=1)
            weight = stirling[customers[these], 1 : width + 1] + opened
            weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            picked = _mixed(keys[these], salt) * weight[:, -1]
            tables[these] = 1 + (weight < picked[:, None]).sum(axis=1)
    rows = np.flatnonzero(customers > EXACT)
    if len(rows):
        base = np.exp(log_base[rows])
        many, base = (np.full(len(rows), MANY), base / (discount * MANY)) if others is None else (others[rows], base)
        tables[rows] = _draw_many(customers[rows], base, many, discount, strength, keys[rows], salt)
    return tables


def _draw_many(customers, base, others, discount, strength, keys, salt) -> np.ndarray:
    """Numbers of tables of dishes with many customers.

    With r = strength / discount + others, the weights of all numbers of tables are the coefficient of
    ``x ** customers`` in ``(1 - base + base * (1 - x) ** discount) ** -r``. At the x that dominates it, the
    tables but one are negative binomial with r + 1 and ``base * (1 - (1 - x) ** discount)``.
    """
    r = strength / discount + others
    base = np.minimum(base, 1 - 1e-12)
    low, high = np.full(len(r), -300.0), np.zeros(len(r))
    for _ in range(60):
        # bisection for the logarithm of 1 - x
        middle = (low + high) / 2
        left = np.exp(middle)
        reached = (1 - left) * r * base * discount * np.exp((discount - 1) * middle) / (1 - base + base * np.exp(discount * middle))
        low, high = np.where(reached > customers, middle, low), np.where(reached > customers, high, middle)
    share = base * (1 - np.exp(discount * high))
    mean = (r + 1) * share / (1 - share)
    # few tables by inversion, many by the normal distribution
    picked, further = _mixed(keys, salt), np.zeros(len(r))
    few = mean < 32
    mass = np.exp((r + 1) * np.log1p(-share))
    below = mass.copy()
    for k in range(256):
        further += few & (below < picked)
        mass = mass * (r + 1 + k) / (k + 1) * share
        below += mass
    wave = np.sqrt(-2 * np.log(np.maximum(picked, 1e-300))) * np.cos(2 * np.pi * _mixed(keys, salt + 1_000_003))
    further = np.where(few, further, np.maximum(np.rint(mean + wave * np.sqrt(mean / (1 - share))), 0.0))
    return np.minimum(1 + further, customers).astype(np.int64)


class Spelling:
    """Restaurants of bytes after two bytes, after one, and after none."""

    def __init__(self, codes: np.ndarray, customers: np.ndarray, salt: int = 0) -> None:
        order = np.argsort(codes)
        codes, customers = codes[order].astype(np.int64), customers[order].astype(np.int64)
        stirling = log_stirling(BYTE_DISCOUNT)
        # dishes of each level, and where a dish of a level stands in the next
        levels, up = [codes], []
        for kinds in (SYMBOLS**2, SYMBOLS):
            below, at = np.unique(levels[-1] % kinds, return_inverse=True)
            levels.append(below)
            up.append(at)
        seated, tables = [customers], [np.minimum(customers, 1)]
        for n in range(2):
            seated.append(np.bincount(up[n], weights=tables[n], minlength=len(levels[n + 1])).astype(np.int64))
            tables.append(np.minimum(seated[n + 1], 1))
        for turn in range(TURNS):
            base = np.full(len(levels[2]), 1.0 / SYMBOLS)
            for n in (2, 1, 0):
                others = self._totals(levels[n], tables[n])[1] - tables[n]
                salt_here = salt * 1000 + turn * 10 + n
                tables[n] = draw_tables(seated[n], np.log(base), others, BYTE_DISCOUNT, STRENGTH, stirling, levels[n].astype(np.uint64), salt_here)
                if n:
                    # what the level says to a dish above it without that dish's own tables
                    above = up[n - 1]
                    rest = seated[n][above] - tables[n - 1]
                    passed_on = (STRENGTH + BYTE_DISCOUNT * self._totals(levels[n], tables[n])[1]) * base
                    own = np.maximum(rest - BYTE_DISCOUNT * np.minimum(tables[n][above], rest), 0.0) + passed_on[above]
                    base = own / (STRENGTH + self._totals(levels[n], seated[n])[1][above] - tables[n - 1])
            for n in range(2):
                seated[n + 1] = np.bincount(up[n], weights=tables[n], minlength=len(levels[n + 1])).astype(np.int64)
                tables[n + 1] = np.minimum(np.maximum(tables[n + 1], seated[n + 1] > 0), seated[n + 1])
        self._keep(levels, seated, tables)

    @staticmethod
    def _totals(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Contexts of dishes, and the sum of their context's values for each dish."""
        places, at = np.unique(codes // SYMBOLS, return_inverse=True)
        return places[at], np.bincount(at, weights=values, minlength=len(places))[at]

    def _keep(self, levels, seated, tables) -> None:
        """The last sample as arrays: what seen dishes add, and what is left to the parent."""
        none = np.zeros(SYMBOLS)
        none[levels[2]] = seated[2] - BYTE_DISCOUNT * tables[2]
        total = seated[2].sum()
        self.none = (none + (STRENGTH + BYTE_DISCOUNT * tables[2].sum()) / SYMBOLS) / (STRENGTH + total)
        self.left, self.seen = {}, {}
        for n, kinds in ((1, SYMBOLS), (0, SYMBOLS**2)):
            context, customers = self._totals(levels[n], seated[n])
            left = np.ones(kinds)
            left[context] = (STRENGTH + BYTE_DISCOUNT * self._totals(levels[n], tables[n])[1]) / (STRENGTH + customers)
            self.left[n] = left
            self.seen[n] = (seated[n] - BYTE_DISCOUNT * tables[n]) / (STRENGTH + customers)
        after_one = np.zeros(SYMBOLS**2)
        after_one[levels[1]] = self.seen[1]
        self.one = after_one.reshape(SYMBOLS, SYMBOLS) + self.left[1][:, None] * self.none[None, :]
        self.codes = levels[0]

    def log(self, codes: np.ndarray) -> np.ndarray:
        """Natural logarithms of the probabilities of bytes after two bytes."""
        found, at = np.unique(codes, return_inverse=True)
        chance = self.left[0][found // SYMBOLS] * self.one.ravel()[found % SYMBOLS**2]
        place = np.minimum(np.searchsorted(self.codes, found), max(len(self.codes) - 1, 0))
        if len(self.codes):
            chance += np.where(self.codes[place] == found, self.seen[0][place], 0.0)
        return np.log(chance)[at]


def spelled(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of every byte of words and of their ends, and where each word's codes start."""
    sizes = np.diff(offsets)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    symbols = np.full(starts[-1] + 2, END, dtype=np.int64)
    keep = np.ones(starts[-1], dtype=bool)
    keep[starts[1:] - 1] = False
    symbols[2:][keep] = data[offsets[0] : offsets[-1]]
    before, before_two = symbols[1:-1].copy(), symbols[:-2].copy()
    # nothing of the word before is seen
    before[starts[:-1]] = before_two[starts[:-1]] = END
    second = starts[:-1][sizes > 0] + 1
    before_two[second] = END
    return (before_two * SYMBOLS + before) * SYMBOLS + symbols[2:], starts[:-1]


class Model:
    """What tasks share in a turn: strengths, discounts, totals of all words, and the spelling."""

    def __init__(self, spelling: Spelling, turn: int = 0, strengths=(1.0, 1.0), discounts=(0.5, 0.5), dishes: int = 0) -> None:
        # of all words and of contexts; tables of all words
        self.strengths, self.discounts, self.dishes = strengths, discounts, dishes
        self.stirling = [log_stirling(d) for d in discounts]
        self.spelling, self.turn = spelling, turn
        # the variable that makes the tables of all words independent of one another
        self.log_x = float(log_gamma(np.array([strengths[0] / discounts[0] + dishes]), np.zeros(1, np.uint64), _salt(turn, 0))[0])

    def totalled(self, sums: dict[str, float]) -> Model:
        """With the totals of the turn, which scores need."""
        # what the spelling leaves to words that are in no training text
        self.unseen = max(1.0 - sums["spelled"], 1e-12)
        self.total = sums["weight"] + (self.strengths[0] + self.discounts[0] * self.dishes) * self.unseen
        self.sent, self.dishes = sums["sent"], sums["dishes"]
        return self

    def parent(self, sent, dishes, log_base) -> np.ndarray:
        """Probabilities of words without a context."""
        (strength, _), (discount, _) = self.strengths, self.discounts
        chance = np.where(sent > 0, np.exp(log_base), self.unseen)
        return (sent - discount * dishes + (strength + discount * self.dishes) * chance) / (strength + self.sent)

    def child(self, customers, tables, of_context, its_tables, parent) -> np.ndarray:
        """Probabilities of words in contexts of so many customers and tables."""
        strength, discount = self.strengths[1], self.discounts[1]
        return (customers - discount * tables + (strength + discount * its_tables) * parent) / (strength + of_context)


def _salt(turn: int, step: int) -> int:
    return (turn + 1) * 100_003 + step * 1_009


def _normal(keys: np.ndarray, salt: int) -> np.ndarray:
    return np.sqrt(-2 * np.log(np.maximum(_mixed(keys, salt), 1e-300))) * np.cos(2 * np.pi * _mixed(keys, salt + 1_000_003))


def log_gamma(shape: np.ndarray, keys: np.ndarray, salt: int) -> np.ndarray:
    """Logarithms of draws from Gamma distributions (Marsaglia and Tsang), by keys and salt alone."""
    big = np.where(shape < 1, shape + 1, shape) - 1 / 3
    out, open_ = np.zeros(len(shape)), np.arange(len(shape))
    for again in range(200):
        z, u = _normal(keys[open_], salt + 17 * again), _mixed(keys[open_], salt + 17 * again + 7)
        size = big[open_]
        v = np.maximum(1 + z / np.sqrt(9 * size), 1e-100) ** 3
        good = (v > 1e-200) & (np.log(np.maximum(u, 1e-300)) < z * z / 2 + size * (1 - v + np.log(v)))
        out[open_[good]] = np.log(size * v)[good]
        open_ = open_[~good]
        if not len(open_):
            break
    small = np.flatnonzero(shape < 1)
    out[small] += np.log(np.maximum(_mixed(keys[small], salt + 5_000_011), 1e-300)) / shape[small]
    return out


def draw_apart(customers, log_weight, discount, stirling, keys, salt) -> np.ndarray:
    """Numbers of tables, each table weighing the same: a restaurant given its Gamma variable.

    With x drawn from Gamma(strength / discount + tables), a restaurant's dishes are independent of one another:
    t tables weigh the generalised Stirling number times ``(discount * x * chance) ** t``.
    """
    return draw_tables(customers, log_weight, None, discount, 0.0, stirling, keys, salt)


def draw_parameters(strength, discount, tables, restaurants, log_x, cells, stirling, rng) -> tuple[float, float]:
    """Strength and discount of a level, drawn given all seatings by auxiliary variables (Teh, 2006).

    ``tables`` are different numbers of tables and ``restaurants`` how many have them; ``log_x`` is the sum of the
    restaurants' Beta variables' logarithms, ``cells[c, t]`` how many dishes have c customers at t tables.
    """
    order = np.argsort(tables)
    tables, behind = tables[order], np.append(np.cumsum(restaurants[order][::-1])[::-1], 0)
    by_strength = by_discount = 0
    for low in range(1, int(tables.max(initial=0)), 1 << 20):
        i = np.arange(low, min(low + (1 << 20), int(tables.max())))
        # every restaurant with more than i tables opened one when it had i
        trials = behind[np.searchsorted(tables, i, side="right")].astype(np.int64)
        hits = rng.binomial(trials, strength / (strength + discount * i))
        by_strength, by_discount = by_strength + hits.sum(), by_discount + (trials - hits).sum()
    # customers leave one by one: the last one was alone, or its step had a factor of which 1 - discount is a part
    cells, alone = cells.astype(np.int64).copy(), 0
    t = np.arange(1, len(cells))
    for c in range(len(cells) - 1, 1, -1):
        with np.errstate(invalid="ignore"):
            opened = np.exp(stirling[c - 1, :-1] - stirling[c, 1:])
        n = cells[c, 1:]
        new = rng.binomial(n, np.clip(np.nan_to_num(opened), 0, 1))
        factor = np.maximum(c - 1 - discount * t, 1e-9)
        alone += rng.binomial(n - new, np.clip(t * (1 - discount) / factor, 0, 1)).sum()
        cells[c - 1, :-1] += new
        cells[c - 1, 1:] += n - new
    strength = rng.gamma(1 + by_strength) / (1 - log_x)
    return min(max(float(strength), 1e-3), 1e9), min(max(float(rng.beta(1 + by_discount, 1 + alone)), 0.02), 0.98)


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers below 2 ** 32, in their order."""
    return zlib.compress(np.ascontiguousarray(values, dtype="<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def stretch(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def pack(places: np.ndarray) -> bytes:
    """Whole numbers, sorted, as compressed differences."""
    return squeeze(np.diff(np.sort(places), prepend=0))


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(stretch(data))


def _floats(values: np.ndarray) -> bytes:
    return values.astype("<f4").tobytes()


def _table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=_BLOCK_TYPES)


def _rows(table: pa.Table, *by: str) -> list[dict]:
    """Rows in an order; what is packed is not copied."""
    order = pc.sort_indices(table, [(k, "ascending") for k in by]).to_pylist() if by else range(len(table))
    binary = [pa.types.is_binary(f.type) for f in table.schema]
    columns = list(zip(table.column_names, table.columns, binary, strict=True))
    return [{name: column[n].as_buffer() if packed else column[n].as_py() for name, column, packed in columns} for n in order]


def _names(row: dict) -> list[bytes]:
    return row["a"].to_pybytes().split(b" ")


def _gathered(sums: dict[int, float]) -> dict:
    return {"kind": _SUMS, "keys": [*sums], "sums": [float(x) for x in sums.values()]}


# Sums by key: scalars, numbers of tables of restaurants, dishes by customers and tables, codes of the spelling.
_SCALARS = ("sent", "dishes", "weight", "spelled", "log_x", "tokens", "words")
_RESTAURANTS, _CELLS, _CODES = (n << 40 for n in (1, 2, 3))


def _cells(customers: np.ndarray, tables: np.ndarray) -> dict[int, int]:
    """Dishes of two customers to ``EXACT`` by customers and tables."""
    few = (customers >= 2) & (customers <= EXACT)
    found, n = np.unique(customers[few] * (EXACT + 1) + tables[few], return_counts=True)
    return dict(zip((found + _CELLS).tolist(), n.tolist(), strict=True))


def _codes(codes: np.ndarray, starts: np.ndarray, dishes: np.ndarray) -> dict[int, int]:
    """Customers of the spelling: its bytes, once for each table of all words."""
    times = np.repeat(dishes, np.diff(np.append(starts, len(codes))))
    found, at = np.unique(codes[times > 0], return_inverse=True)
    n = np.bincount(at, weights=times[times > 0], minlength=len(found))
    return dict(zip((found + _CODES).tolist(), n.tolist(), strict=True))


def _spelled_words(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return spelled(np.frombuffer(b"".join(words), dtype=np.uint8), np.cumsum([0, *map(len, words)]))


def _number(table: pa.Table) -> pa.Table:
    """Words of a part in their order, with counts; for each chunk, where its words stand."""
    rows = _rows(table, "chunk")
    given = [_names(r) for r in rows]
    words = sorted(set().union(*given))
    place = dict(zip(words, range(len(words)), strict=True))
    count, out = np.zeros(len(words), dtype=np.int64), []
    for row, names in zip(rows, given, strict=True):
        at = np.fromiter(map(place.__getitem__, names), dtype=np.int64, count=len(names))
        count[at] += stretch(row["b"])
        out.append({"kind": _ASKED, "chunk": row["chunk"], "part": row["part"], "a": squeeze(at)})
    for row in out:
        row["b"] = squeeze(count[stretch(row["a"])])
    known = (count > 0).astype(np.int64)
    sums = _codes(*_spelled_words(words), known) | {_SCALARS.index("tokens"): count.sum(), _SCALARS.index("words"): known.sum()}
    state = {"kind": _STATE, "part": rows[0]["part"], "a": b" ".join(words), "b": squeeze(count)}
    return _table([state, *out, _gathered(sums)])


def _pair(parts: int, buckets: int, tokens: int, words: int):
    """Different words in context of a chunk by bucket, and its texts as places of them."""

    def pair(table: pa.Table) -> pa.Table:
        rows = _rows(table, "kind", "part")
        text = rows.pop()
        number = np.concatenate([stretch(r["a"]) * parts + r["part"] for r in rows])
        count = np.concatenate([stretch(r["b"]) for r in rows])
        sizes = np.frombuffer(text["b"], dtype="<i8")
        held = np.repeat(np.array(text["held"], dtype=bool), sizes)
        # numbers of words in their order, so that pairs come in theirs
        order = np.argsort(number)
        number, rank = number[order], np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        token = rank[stretch(text["a"])]
        count, starts = count[order], np.cumsum(sizes) - sizes
        n_known = np.add.reduceat((count > 0)[token], starts, dtype=np.int64)
        base = np.add.reduceat(np.log10((count + 0.1) / (tokens + 0.1 * (words + 1)))[token], starts)
        # the word before a text's first is the end of the one before, and every chunk ends with an end
        codes = np.roll(token, 1) * len(number)
        codes += token
        del token
        pairs, place = _places(codes)
        del codes
        train = np.bincount(place[~held], minlength=len(pairs))
        before, word = np.divmod(pairs, len(number))
        before, word = number[before], number[word]
        bucket = (_mixed(_pair_keys(before, word), 1) * buckets).astype(np.int64)
        order = np.argsort(bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64), kind="stable")
        new = np.empty(len(order), dtype=np.int64)
        new[order] = np.arange(len(order))
        # in the order of places within a text, as differences
        place = new[place]
        place += np.repeat(np.arange(len(sizes)) << 32, sizes)
        place.sort()
        place &= (1 << 32) - 1
        steps = np.diff(place, prepend=0)
        steps[starts] = place[starts]
        chunk, out = text["chunk"], []
        first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for low, high in zip(first, [*first[1:], len(order)], strict=True):
            these = order[low:high]
            out.append({"kind": _BLOCK, "chunk": chunk, "part": int(bucket[these[0]]), "a": pack(before[these]), "b": squeeze(word[these]), "c": squeeze(train[these])})
        text |= {"a": squeeze(steps), "b": sizes.tobytes(), "c": base.tobytes(), "d": n_known.tobytes()}
        return _table([*out, text])

    return pair


def _places(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different codes, sorted, and which of them each one is."""
    order = np.argsort(codes)
    codes = codes[order]
    new = np.append(True, codes[1:] != codes[:-1])
    place = np.empty(len(codes), dtype=np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return codes[new], place


def _pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (before.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)


def _said(bucket: int, ids: np.ndarray, bounds: np.ndarray, before, word, more: np.ndarray) -> list[dict]:
    """For each part, how many customers of its contexts and words have no table of their own."""
    as_context, as_word = (np.bincount(x, weights=more, minlength=len(ids)).astype(np.int64) for x in (before, word))
    cuts = zip(bounds[:-1], bounds[1:], strict=True)
    return [
        {"kind": _SAID, "chunk": bucket, "part": int(ids[low] >> 32), "a": squeeze(ids[low:high] & 0xFFFFFFFF), "b": squeeze(as_context[low:high]), "c": squeeze(as_word[low:high])}
        for low, high in cuts
        if low < high
    ]


def _bounds(ids: np.ndarray) -> np.ndarray:
    """Where another part begins."""
    return np.append(np.flatnonzero(np.diff(ids >> 32, prepend=-1)), len(ids))


def _count(parts: int):
    """Pairs of a bucket with more than one customer, and which of them each chunk has."""

    def count(table: pa.Table) -> pa.Table:
        rows = _rows(table, "chunk")
        bucket = rows[0]["part"]
        keys = [_pair_keys(unpack(r["a"]), stretch(r["b"])) for r in rows]
        every, at = np.unique(np.concatenate(keys), return_inverse=True)
        customers = np.bincount(at, weights=np.concatenate([stretch(r["c"]) for r in rows]), minlength=len(every)).astype(np.int64)
        free = customers >= 2
        # a chunk's pairs: 0 without customers, 1 with one, 2 and more: which of the others
        which = np.minimum(customers, 1)
        which[free] = 2 + np.arange(free.sum())
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        out = [{"kind": _ASKED, "chunk": r["chunk"], "part": bucket, "a": squeeze(which[x])} for r, x in zip(rows, np.split(at, cuts), strict=True)]
        key, customers = every[free], customers[free]
        both = np.stack([(key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)])
        ids, at = np.unique(both % parts << 32 | both // parts, return_inverse=True)
        before, word = at.reshape(2, -1)
        # the first seating: one table each
        out += _said(bucket, ids, _bounds(ids), before, word, customers - 1)
        out.append({"kind": _STATE, "part": bucket, "a": squeeze(both[0]), "b": squeeze(both[1]), "c": squeeze(customers)})
        return _table([*out, _gathered(_cells(customers, np.ones(len(customers), np.int64)))])

    return count


def _seat_words(model: Model, parts: int, last: bool):
    """Tables of the words of a part, and what their restaurants as contexts and they as words tell each bucket.

    After the last turn nobody asks.
    """

    def seat(state: pa.Table, said: pa.Table) -> pa.Table:
        if not state.num_rows:
            raise ValueError("a bucket speaks of words that no part has")
        (strength, s_context), discount = model.strengths, model.discounts[0]
        row, said = _rows(state)[0], _rows(said, "chunk")
        words, sent = _names(row), stretch(row["b"])
        known, heard = sent > 0, stretch(row["c"] or row["b"])
        tables = heard.copy()
        for r in said:
            at = stretch(r["a"])
            tables[at] -= stretch(r["b"])
            sent[at] -= stretch(r["c"])
        key = (np.arange(len(words)) * parts + row["part"]).astype(np.uint64)
        codes, starts = _spelled_words(words)
        base = np.maximum(np.add.reduceat(model.spelling.log(codes), starts), LEAST_LOG)
        dishes = draw_apart(sent, np.log(discount) + model.log_x + base, discount, model.stirling[0], key, _salt(model.turn, 1))
        # the probabilities of all words are drawn as well; what is left to the spelling is small
        weight = np.full(len(words), -np.inf)
        weight[known] = log_gamma((sent - discount * dishes)[known], key[known], _salt(model.turn, 3))
        weight = np.logaddexp(weight, np.log(strength + discount * model.dishes) + base)
        out = [
            {"kind": _REPLY, "chunk": r["chunk"], "part": row["part"], "a": squeeze(tables[at]), "b": _floats(weight[at])}
            for r in said
            if not last
            for at in [stretch(r["a"])]
        ]
        out.append({"kind": _STATE, "part": row["part"], "a": squeeze(heard), "b": squeeze(tables), "c": squeeze(sent), "d": squeeze(dishes), "e": base.tobytes()})
        # Beta variables of restaurants with more than one customer
        several = heard > 1
        one, other = (log_gamma(s, key[several], _salt(model.turn, n)) for s, n in ((np.full(several.sum(), s_context + 1), 4), (heard[several] - 1.0, 5)))
        held = np.unique(tables[heard > 0], return_counts=True)
        scalars = (sent.sum(), dishes.sum(), np.exp(weight[known]).sum(), np.exp(base[known]).sum(), (one - np.logaddexp(one, other)).sum())
        sums = dict(enumerate(scalars)) | dict(zip((held[0] + _RESTAURANTS).tolist(), held[1].tolist(), strict=True))
        return _table([*out, _gathered(sums | _cells(sent, dishes) | _codes(codes, starts, dishes))])

    return seat


def _seat_pairs(model: Model, total: float, parts: int):
    """Tables of the words in context of a bucket."""

    def seat(state: pa.Table, replies: pa.Table) -> pa.Table:
        row, replies = _rows(state)[0], _rows(replies, "part")
        both, customers = np.stack([stretch(row["a"]), stretch(row["b"])]), stretch(row["c"])
        ids, at = np.unique(both % parts << 32 | both // parts, return_inverse=True)
        before, word = at.reshape(2, -1)
        strength, discount = model.strengths[1], model.discounts[1]
        seats = np.concatenate([np.zeros(0, dtype=np.int64), *[stretch(r["a"]) for r in replies]])
        weight = np.concatenate([np.zeros(0, "<f4"), *[np.frombuffer(r["b"], dtype="<f4") for r in replies]]).astype(np.float64)
        # a context's variable is the same in every bucket
        log_x = log_gamma(strength / discount + seats, ids.astype(np.uint64), _salt(model.turn, 2))
        weighs = np.log(discount) + log_x[before] + weight[word] - np.log(total)
        tables = draw_apart(customers, weighs, discount, model.stirling[1], _pair_keys(*both), _salt(model.turn, 6))
        out = _said(row["part"], ids, _bounds(ids), before, word, customers - tables)
        out.append({"kind": _STATE, "part": row["part"], "a": squeeze(customers), "b": squeeze(tables)})
        return _table([*out, _gathered(_cells(customers, tables))])

    return seat


def mean_score(samples: list[Model], pairs, contexts, parent) -> np.ndarray:
    """Logarithms of probabilities, averaged over the samples before.

    A row of ``pairs`` and ``contexts`` has customers, then tables by sample; one of ``parent`` probabilities.
    """
    mean = [m.child(pairs[:, 0], pairs[:, k + 1], contexts[:, 0], contexts[:, k + 1], parent[:, k]) for k, m in enumerate(samples)]
    return np.log10(sum(mean) / len(samples))


def _tell_words(samples: list[Model]):
    """For each chunk its words' customers and tables as contexts and their probabilities as words, by sample."""

    def tell(asked: pa.Table, states: pa.Table) -> pa.Table:
        seated, values = [], []
        for model, row in zip(samples, _rows(states, "sample"), strict=True):
            heard, tables, sent, dishes = (stretch(row[c]) for c in "abcd")
            seated.append(tables)
            values.append(model.parent(sent, dishes, np.frombuffer(row["e"])))
        seated, values, out = np.stack([heard, *seated]), np.stack(values), []
        for row in _rows(asked, "chunk"):
            at = stretch(row["a"])
            out.append({"kind": _TOLD_WORDS, "chunk": row["chunk"], "part": row["part"], "a": squeeze(at), "b": squeeze(seated[:, at].T), "c": _floats(values[:, at].T)})
        return _table(out)

    return tell


def _tell_pairs(asked: pa.Table, states: pa.Table) -> pa.Table:
    """For each chunk the customers of its pairs and their tables, by sample."""
    found = [(stretch(r["a"]), stretch(r["b"])) for r in _rows(states, "sample")]
    # pairs without customers and with one have as many tables
    few = np.arange(2)
    values = [np.concatenate([few, x]) for x in (found[0][0], *[tables for _, tables in found])]
    out = []
    for row in _rows(asked, "chunk"):
        at = stretch(row["a"])
        out.append({"kind": _TOLD_PAIRS, "chunk": row["chunk"], "part": row["part"], "a": squeeze(np.concatenate([v[at] for v in values]))})
    return _table(out)


def _score(samples: list[Model], parts: int, tokens: int):
    """Scores of the texts of a chunk."""

    def score(table: pa.Table) -> pa.Table:
        rows = _rows(table, "kind", "part")
        kinds = {k: [r for r in rows if r["kind"] == k] for k in (_BLOCK, _TEXT, _TOLD_WORDS, _TOLD_PAIRS)}
        text = kinds[_TEXT][0]
        n = len(samples)
        number = np.concatenate([stretch(r["a"]) * parts + r["part"] for r in kinds[_TOLD_WORDS]])
        order = np.argsort(number)
        number = number[order]
        heard = np.concatenate([stretch(r["b"]).reshape(-1, n + 1) for r in kinds[_TOLD_WORDS]])[order]
        parent = np.concatenate([np.frombuffer(r["c"], dtype="<f4").reshape(-1, n) for r in kinds[_TOLD_WORDS]])[order]
        scores = []
        for block, told in zip(kinds[_BLOCK], kinds[_TOLD_PAIRS], strict=True):
            before = heard[np.searchsorted(number, unpack(block["a"]))]
            word = parent[np.searchsorted(number, stretch(block["b"]))].astype(np.float64)
            seated = stretch(told["a"]).reshape(n + 1, -1)
            scores.append(mean_score(samples, seated.T, before, word))
        scores = np.concatenate(scores)
        sizes = np.frombuffer(text["b"], dtype="<i8")
        starts = np.cumsum(sizes) - sizes
        place = stretch(text["a"])
        np.cumsum(place, out=place)
        # every text's differences begin anew
        place -= np.repeat(np.append(0, place[starts[1:] - 1]), sizes)
        found = np.add.reduceat(scores[place], starts)
        columns = [
            pa.array(text["ids"], pa.string()), pa.array(text["held"], pa.bool_()), pa.array(sizes), pa.array(np.frombuffer(text["d"], dtype="<i8")),
            pa.array(np.full(len(sizes), tokens, dtype=np.int64)), pa.array(np.frombuffer(text["c"])), pa.array(found),
        ]
        return pa.Table.from_arrays(columns, [c.split()[0] for c in SUMS.split(", ")])

    return score


class _Numbers(dict):
    """Words by the order they come in."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Chunk:
    """Texts of a chunk as numbers of words; what is emitted when it is full."""

    def __init__(self, number: int) -> None:
        self.number, self.words, self.texts, self.tokens = number, _Numbers({b"": 0}), [], 0

    def add(self, doc_id, held: bool, text: str | None) -> None:
        found = [*map(self.words.__getitem__, (text or "").encode().lower().split()), 0]
        self.texts.append((doc_id, held, np.fromiter(found, dtype=np.int32, count=len(found))))
        self.tokens += len(found)

    def rows(self, parts: int) -> pa.Table:
        ids, held, found = zip(*self.texts, strict=True)
        sizes, tokens = np.array([len(f) for f in found]), np.concatenate(found)
        self.texts, found = [], None
        train = np.bincount(tokens[~np.repeat(np.array(held), sizes)], minlength=len(self.words))
        names = list(self.words)
        part = np.fromiter(map(zlib.crc32, names), dtype=np.int64, count=len(names)) % parts
        # words are numbered part by part
        order = np.argsort(part, kind="stable")
        new = np.empty(len(order), dtype=np.int32)
        new[order] = np.arange(len(order))
        out = [{"kind": _TEXT, "chunk": self.number, "part": -1, "a": squeeze(new[tokens]), "b": sizes.astype("<i8").tobytes(), "ids": ids, "held": held}]
        first = np.flatnonzero(np.diff(part[order], prepend=-1))
        for low, high in zip(first, [*first[1:], len(order)], strict=True):
            these = order[low:high]
            out.append({"kind": _WORDS, "chunk": self.number, "part": int(part[these[0]]), "a": b" ".join([names[n] for n in these]), "b": squeeze(train[these])})
        return _table(out)


def _chunks(parts: int):
    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for doc_id, held, text in zip(*(batch.column(c) for c in ("doc_id", "held_out", "text")), strict=True):
                chunk.add(doc_id.as_py(), held.as_py(), text.as_py())
                if chunk.tokens >= CHUNK_TOKENS:
                    yield from chunk.rows(parts).to_batches()
                    chunk = _Chunk(chunk.number + 1)
        if chunk.texts:
            yield from chunk.rows(parts).to_batches()

    return chunks


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a task's rows."""
    key, value = np.zeros(0, dtype=np.int64), np.zeros(0)
    for batch in batches:
        key, value = (np.concatenate([x, batch.column(c).flatten().to_numpy()]) for x, c in ((key, "keys"), (value, "sums")))
        key, at = np.unique(key, return_inverse=True)
        value = np.bincount(at, weights=value, minlength=len(key))
    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(value)], ["key", "value"])


class _Sums:
    """Sums of a stage, added up by Spark."""

    def __init__(self, blocks: DataFrame) -> None:
        rows = _kind(blocks, _SUMS).select("keys", "sums").mapInArrow(_added, "key long, value double")
        found = rows.groupBy("key").agg(F.sum("value").alias("value")).orderBy("key").toPandas()
        self.key, self.value = found["key"].to_numpy(dtype=np.int64), found["value"].to_numpy(dtype=np.float64)

    def scalars(self) -> dict[str, float]:
        found = dict(zip(self.key.tolist(), self.value.tolist(), strict=True))
        return {name: found.get(n, 0.0) for n, name in enumerate(_SCALARS)}

    def of(self, space: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.searchsorted(self.key, [space, space + (1 << 40)])
        return self.key[low:high] - space, self.value[low:high].astype(np.int64)

    def cells(self) -> np.ndarray:
        out = np.zeros((EXACT + 1, EXACT + 1), dtype=np.int64)
        at, n = self.of(_CELLS)
        out.ravel()[at] = n
        return out


def _kind(blocks: DataFrame, kind: int) -> DataFrame:
    return blocks.filter(F.col("kind") == kind)


def _together(left: DataFrame, right: DataFrame, function, *, by: tuple[str, str] = ("part", "part")) -> DataFrame:
    return left.groupBy(by[0]).cogroup(right.groupBy(by[1])).applyInArrow(function, BLOCKS)


def learn_pairs(words: DataFrame, counted: DataFrame, parts: int) -> tuple[list[Model], DataFrame, DataFrame, list[DataFrame]]:
    """Samples of the chain: what tasks share, tables of words and of pairs, and the staged tables that hold them."""
    seen, drawn = _Sums(words), _Sums(counted)
    spelling = Spelling(*seen.of(_CODES))
    model = Model(spelling, dishes=int(seen.scalars()["words"]))
    rng, pairs, samples, of_words, of_pairs, sampled = np.random.default_rng(12), counted, [], [], [], []
    vocabulary, state = _kind(words, _STATE), _kind(counted, _STATE)
    for turn in range(TURNS_OF_ALL + 1):
        seated = _materialise(_together(vocabulary, _kind(pairs, _SAID), _seat_words(model, parts, turn == TURNS_OF_ALL)), "seated-words")
        sums = _Sums(seated)
        scalars = sums.scalars()
        model.totalled(scalars)
        if turn > TURNS_OF_ALL - SAMPLES:
            samples.append(model)
            sampled += [seated, pairs]
            of_words.append(_kind(seated, _STATE).withColumn("sample", F.lit(len(of_words))))
            of_pairs.append(_kind(pairs, _STATE).withColumn("sample", F.lit(len(of_pairs))))
        if turn == TURNS_OF_ALL:
            break
        # strengths and discounts given all seatings, then tables of pairs given them
        (s_words, s_context), (d_words, d_context) = model.strengths, model.discounts
        one = np.log(max(rng.beta(s_words + 1, max(scalars["sent"] - 1, 1)), 1e-300))
        of_all = draw_parameters(s_words, d_words, np.array([int(scalars["dishes"])]), np.array([1]), one, sums.cells(), model.stirling[0], rng)
        of_contexts = draw_parameters(s_context, d_context, *sums.of(_RESTAURANTS), scalars["log_x"], drawn.cells(), model.stirling[1], rng)
        total = model.total
        model = Model(Spelling(*sums.of(_CODES), turn + 1), turn + 1, *zip(of_all, of_contexts, strict=True), int(scalars["dishes"]))
        seat = _seat_pairs(model, total, parts)
        again = _materialise(_together(state, _kind(seated, _REPLY), seat, by=("part", "chunk")), "seated-pairs")
        if not samples:
            release(seated, *[pairs] * (turn > 0))
        pairs, drawn = again, _Sums(again)
    return samples, _union(of_words), _union(of_pairs), sampled


def learn(words: DataFrame) -> tuple[dict, list[Model]]:
    """The model of a small table of counts: words, each with how often it stands in which contexts.

    Contexts are any numbers. The chain is the one of texts, with one part and one bucket.
    """
    rows = sorted(words.select("word", "contexts").collect(), key=lambda r: bytes(r["word"]))
    names = [bytes(r["word"]) for r in rows]
    found = sorted((p["context"], n, p["train"]) for n, r in enumerate(rows) for p in r["contexts"])
    context, word, train = (np.array(x, dtype=np.int64) for x in zip(*found, strict=True))
    contexts, before = np.unique(context, return_inverse=True)
    before += len(names)
    every = [*names, *(b"%d" % c for c in contexts)]
    sent, heard = (np.bincount(x, weights=train, minlength=len(every)).astype(np.int64) for x in (word, before))
    known = (sent > 0).astype(np.int64)
    state = {"kind": _STATE, "part": 0, "a": b" ".join(every), "b": squeeze(sent), "c": squeeze(heard)}
    sums = _codes(*_spelled_words(every), known) | {_SCALARS.index("words"): known.sum()}
    block = {"kind": _BLOCK, "chunk": 0, "part": 0, "a": pack(before), "b": squeeze(word), "c": squeeze(train)}
    spark, counted = words.sparkSession, _count(1)(_table([block]))
    samples, of_words, of_pairs, sampled = learn_pairs(spark.createDataFrame(_table([state, _gathered(sums)])), spark.createDataFrame(counted), 1)
    asked = _table([{"kind": _ASKED, "chunk": 0, "part": 0, "a": squeeze(np.arange(len(every)))}])
    told = _rows(_tell_words(samples)(asked, of_words.toArrow()))[0]
    pairs = _rows(_tell_pairs(counted.filter(pc.field("kind") == _ASKED), of_pairs.toArrow()))[0]
    heard, parent = stretch(told["b"]).reshape(-1, len(samples) + 1), np.frombuffer(told["c"], dtype="<f4").reshape(-1, len(samples))
    scores = mean_score(samples, stretch(pairs["a"]).reshape(len(samples) + 1, -1).T, heard[before], parent[word].astype(np.float64))
    learned = {name: (int(n), [], []) for name, n in zip(names, sent, strict=False)}
    for n, c, score in zip(word.tolist(), context.tolist(), scores.tolist(), strict=True):
        learned[names[n]][1].append(c)
        learned[names[n]][2].append(score)
    return learned, samples


def _scores(learned: dict, samples: list[Model]):
    """Count of each word and its scores in its contexts, as ``learn`` found them over the samples."""

    def scores(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(word, *learned[word]) for word in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_pylist([dict(zip(_SCORE_TYPES.names, r, strict=True)) for r in rows], schema=_SCORE_TYPES)

    return scores


def _union(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def _materialise(df: DataFrame, name: str) -> DataFrame:
    """Written once; the shuffle files that led to it are not needed any more."""
    spark, before = df.sparkSession, df.sparkSession.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        return materialise(df, name)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def score_documents(docs: DataFrame) -> DataFrame:
    """Every text with its logarithms of probability under single words and under the model.

    Learns from texts whose checksum of the id is not divisible by ten. Tokens are the words in lower
    case and one end per text. Words that are in no training text are one outcome, as in the score by
    single words; it has what the spellings of the known words leave.

    Words are dealt over as many parts as the session has shuffle partitions, pairs of a word and the one before
    it over as many buckets, by a hash of the pair, so neither a frequent word nor a context stands in one task.
    A chunk of some 2 million tokens (or one text, if that is longer), a part and a bucket must fit a task each:
    give a larger table more shuffle partitions. There may be 2 ** 32 different words.

    Nulls: a null text is empty and has its end alone; a null id is never held out.
    Texts of any length are whole; repeated rows are scored each. An empty table gives no rows. Without
    training texts all words are unseen. Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    parts = buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), held.alias("held_out"), "text")
    chunks = _materialise(texts.mapInArrow(_chunks(parts), BLOCKS), "token-chunks")
    words = _materialise(_kind(chunks, _WORDS).groupBy("part").applyInArrow(_number, BLOCKS), "words")
    totals = _Sums(words).scalars()
    tokens, different = int(totals["tokens"]), int(totals["words"])
    both = _kind(words, _ASKED).unionByName(_kind(chunks, _TEXT))
    pairs = _materialise(both.groupBy("chunk").applyInArrow(_pair(parts, buckets, tokens, different), BLOCKS), "pairs")
    release(chunks)
    counted = _materialise(_kind(pairs, _BLOCK).groupBy("part").applyInArrow(_count(parts), BLOCKS), "counted-pairs")
    samples, of_words, of_pairs, sampled = learn_pairs(words, counted, parts)
    told_words = _materialise(_together(_kind(words, _ASKED), of_words, _tell_words(samples)), "told-words")
    told_pairs = _materialise(_together(_kind(counted, _ASKED), of_pairs, _tell_pairs), "told-pairs")
    release(words, counted, *sampled)
    # counts of blocks have done their part
    asked = pairs.withColumn("c", F.when(F.col("kind") == _TEXT, F.col("c")))
    result = _union([asked, told_words, told_pairs]).groupBy("chunk").applyInArrow(_score(samples, parts, tokens), SUMS)
    names = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return result.select(F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), *names)
