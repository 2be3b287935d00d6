"""Personal data: fixed patterns as seeds, and contexts learnt from them.

The seeds are found by four expressions. A cue is what stands beside an identifier and announces it:
a word that ends in ``:``, ``=`` or ``#``, with an opening quote perhaps, or the one to three words or
marks to the left or to the right of it. Cues and the tokens beside them make a graph, whose edges
Spark scores in turns: a cue is as good as the mean of its tokens, a token as good as its cues
together, seeds are certain. Cues that stay good give identifiers the expressions miss, which make
further cues good.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waterline.llm.tables import prepare
from waterline.sources.staging import materialise

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
# A cue must announce so many different seeds, and score so high, before it is believed.
LEAST_SEEDS, LEAST_SCORE = 5, 0.8
# Shorter tokens are no identifiers.
LEAST_LENGTH = 4

# Possessive runs and the look-behind only spare repeated attempts that cannot succeed.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_CUE = re.compile(r"(?<![\w-])[-_]*+([^\W_][\w-]*+)[\x20\t]*+([:=#])[\x20\t]*+[\"'(<]?([^\s\"'<>()]+)")
_RUN = re.compile(r"[^\s\"'<>()]+")
_OPEN = re.compile(r"(?<![^\s\"'<>()])[^\s\"'<>()0-9@]*+[0-9@][^\s\"'<>()]*+")
# Groups of digits, bracketed perhaps, with single spaces, dots, hyphens or slashes between them.
_NUMBER = re.compile(r"\+?(?:\([0-9]++\)|[0-9]++)(?:(?:[\x20\xa0./-]|\x20-\x20)?(?:\([0-9]++\)|[0-9]++))*(?![\w@])")
_WORD = re.compile(r"\w+|[^\w\s]")
_DIGITS = re.compile(r"[0-9]+")
_LIKELY = re.compile(r"[0-9@]")
# Words or marks of a context, and how far from an identifier they are looked for at first.
CONTEXT, REACH = 3, 256
# Contexts that are sent to the tasks at once, and the share of the rows that refutes most of them.
AT_ONCE, FIRST_SHARE = 50_000, 64


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for domain in _DOMAIN.finditer(text):
        start = domain.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < domain.start():
            end = domain.end()
            yield start, end


def _is_ip(match: str) -> bool:
    parts = [p.lstrip("0") for p in match.split(".")]
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def _is_card(match: str) -> bool:
    digits = _NOT_DIGIT.sub("", match)
    if not 16 <= len(digits) <= 19:
        return False
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def _is_phone(match: str) -> bool:
    return 8 <= len(_NOT_DIGIT.sub("", match)) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the four expressions, by kind and start; ends are exclusive."""
    spans = []
    if "@" in text:
        spans += [(0, s, e) for s, e in _emails(text)]
    for kind, pattern, valid in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
        if kind != 3 or "+" in text:
            spans += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(m[0])]
    return spans


def _value(text: str, start: int, end: int) -> tuple[int, int, int, int]:
    """Start and end of the announced token, then of the number it begins.

    Spaces and brackets belong to a number only, so the kind of a cue decides on which of the two
    it announces: cards and phones are numbers, addresses are tokens.
    """
    run = text[start:end]
    stop = end - len(run) + len(run.rstrip(".,;:!?"))
    for at in (start - 1, start) if start and text[start - 1] == "(" else (start,):
        number = _NUMBER.match(text, at)
        if number and number.end() > stop:
            return start, stop, at, number.end()
    return start, stop, start, stop


def _normal(words: list[str]) -> list[str]:
    return [_DIGITS.sub("0", w.lower()) for w in words]


def _before(text: str, start: int) -> list[str]:
    """The last words or marks before a place; the stretch searched grows until they are whole."""
    reach = REACH
    while True:
        low = max(0, start - reach)
        found = [m for m in _WORD.finditer(text, low, start) if m.start() > low or not low]
        if len(found) >= CONTEXT or not low:
            return [m[0] for m in found[-CONTEXT:]]
        reach *= 4


def _contexts(text: str, start: int, end: int) -> list[str]:
    """The contexts of a place: ``<`` and the words before it, ``>`` and the words after it.

    Marks alone are no context.
    """
    left, right = _normal(_before(text, start)), _normal([m[0] for m, _ in zip(_WORD.finditer(text, end), range(CONTEXT))])
    found = [*(("<", left[-n:]) for n in range(1, len(left) + 1)), *((">", right[:n]) for n in range(1, len(right) + 1))]
    return [side + " ".join(words) for side, words in found if any(w[0].isalnum() for w in words)]


def cue_rows(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, bool, str, int, int, int]]:
    """(cue, number, token, kind or -1, start, end) of each token beside a cue.

    Each is there as a token and as a number, which may be longer. A seed is the token, with its
    kind. Tokens that touch another seed are left out: that part of the text is settled. A word with
    a mark announces any token, a context those that could be identifiers.
    """
    starts = {s: (k, e) for k, s, e in reversed(spans)}
    covered = sorted((s, e) for _, s, e in spans)
    rows = []

    def forms(start: int, end: int, at: int) -> tuple[int, list[tuple[int, int] | None]]:
        """Place in ``covered``, and token and number where no seed is touched."""
        first, stop, wide, far = _value(text, start, end)
        while at < len(covered) and covered[at][1] <= first:
            at += 1
        following = covered[at][0] if at < len(covered) else len(text)
        if following < stop:
            return at, [None, None]
        return at, [(first, stop), (wide, far) if following >= far else (first, stop)]

    at = 0
    for match in _CUE.finditer(text):
        start, end = match.span(3)
        cue = match[1].lower() + match[2]
        # a seed may begin with the bracket before the token, never the other way round
        if start in starts:
            kind, end = starts[start]
            rows += [(cue, number, text[start:end].lower(), kind, start, end) for number in (False, True)]
            continue
        at, places = forms(start, end, at)
        rows += [(cue, number, text[p[0] : p[1]].lower(), -1, *p) for number, p in enumerate(places) if p]
    for kind, start, end in spans:
        token = text[start:end].lower()
        rows += [(cue, number, token, kind, start, end) for cue in _contexts(text, start, end) for number in (False, True)]
    at = settled = 0
    for match in _OPEN.finditer(text):
        at, places = forms(*match.span(), at)
        for number, place in enumerate(places):
            # the later groups of a number are no numbers of their own
            if not place or (number and place[0] < settled):
                continue
            token = text[place[0] : place[1]].lower()
            settled = max(settled, place[1]) if number else settled
            if len(token) >= LEAST_LENGTH and _LIKELY.search(token):
                rows += [(cue, number, token, -1, *place) for cue in _contexts(text, *place)]
    return [(cue, bool(number), *rest) for cue, number, *rest in rows]


def slot_words(text: str, pool: dict[str, set[str]]) -> set[tuple[str, str]]:
    """(context, word) of the words beside a context of the pool that could not be identifiers.

    ``pool`` has the contexts by ``<`` or ``>`` and their word next to the identifier.
    """
    found = [(m.start(), m.end(), m[0]) for m in _WORD.finditer(text)]
    words = _normal([w for _, _, w in found])
    out = set()
    for i, word in enumerate(words):
        for side, step in (("<", 1), (">", -1)):
            contexts = pool.get(side + word)
            if not contexts or not 0 <= i + step < len(words):
                continue
            start, end, beside = found[i + step]
            if not beside[0].isalnum():
                continue
            while start and _RUN.match(text[start - 1]):
                start -= 1
            if _LIKELY.search(_RUN.match(text, start)[0]):
                continue
            for n in range(1, CONTEXT + 1):
                near = words[max(0, i - n + 1) : i + 1] if step > 0 else words[i : i + n]
                context = side + " ".join(near)
                if len(near) == n and context in contexts:
                    out.add((context, words[i + step]))
    return out


def show(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("cue", "number", "token", "kind", "start", "stop")
    cue = pa.struct(list(zip(names, (pa.string(), pa.bool_(), pa.string(), pa.int32(), pa.int32(), pa.int32()), strict=True)))
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])
    for batch in batches:
        base, cues = [], []
        for text in batch.column(1):
            body = text.as_py() or ""
            spans = base_spans(body)
            base.append([dict(zip(("kind", "start", "stop"), s, strict=True)) for s in spans])
            cues.append([dict(zip(names, c, strict=True)) for c in cue_rows(body, spans)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, pa.list_(span)), pa.array(cues, pa.list_(cue))], names=["key", "base", "cues"])


def scan(docs: DataFrame, key: Column) -> DataFrame:
    """``(key, base, cues)`` of every row: seeds and the tokens beside cues in the whole text."""
    prepare(docs.sparkSession)
    rows = docs.select(key.alias("key"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    spans = "array<struct<kind:int,start:int,stop:int>>"
    cues = "array<struct<cue:string,number:boolean,token:string,kind:int,start:int,stop:int>>"
    return rows.mapInArrow(_scan, f"key {kind}, base {spans}, cues {cues}")


def identifier(token: Column) -> Column:
    """Whether a token could be an identifier at all."""
    return token.rlike("[0-9@]") & (F.length(token) >= LEAST_LENGTH)


def _is_context(cue: Column) -> Column:
    return F.substring(cue, 1, 1).isin("<", ">")


def _good() -> Column:
    return (F.col("instances") >= LEAST_SEEDS) & (F.col("score") >= LEAST_SCORE)


def edges_of(cues: DataFrame) -> DataFrame:
    """``(cue, number, token, kind, open)``, once per cue and token."""
    edges = cues.groupBy("cue", "number", "token").agg(F.max("kind").alias("kind"))
    return edges.withColumn("open", (F.col("kind") < 0) & identifier(F.col("token")))


def cue_scores(edges: DataFrame, others: DataFrame | None = None, rounds: int = ROUNDS) -> DataFrame:
    """``(cue, number, kind, score, instances)`` of the cues in ``edges``.

    ``others(cue, others)`` counts tokens of a cue that are not in ``edges``. A token that is a seed
    scores 1 for its kind. A cue's score for a kind is the mean over its tokens; another token's is
    ``1 - product(1 - cue score)`` over its cues if it could be an identifier, where contexts count
    only once they are good. Instances are the seeds and the tokens beside good cues. There are
    ``rounds`` rounds, and more while they make further cues good.
    """
    by = ["cue", "number"]
    sizes = edges.groupBy(*by).agg(F.count("*").alias("tokens"))
    if others is not None:
        sizes = sizes.join(others, "cue", "left").select(*by, (F.col("tokens") + F.coalesce("others", F.lit(0))).alias("tokens"))
    # addresses are tokens, cards and phones are numbers
    seeds = edges.filter("kind >= 0 and number = (kind >= 2)").groupBy(*by, "kind").agg(F.count("*").alias("instances"))
    seeds = seeds.withColumn("believed", F.col("instances").cast("double"))
    open_edges = edges.filter("open").select(*by, "token")

    def scored(sums: DataFrame) -> DataFrame:
        rows = sums.join(sizes, by).select(*by, "kind", (F.col("believed") / F.col("tokens")).alias("score"), "instances")
        return materialise(rows, "cue_scores")

    scores, good, done = scored(seeds), 0, 0
    while True:
        before, good = good, scores.filter(_good()).count()
        if done >= rounds and good <= before:
            return scores
        believed = (
            open_edges.join(scores.filter(_good() | ~_is_context(F.col("cue"))).select(*by, "kind", "score", _good().alias("good")), by)
            .groupBy("token", "number", "kind")
            # the sum of logarithms is the product; a certain cue makes a certain token
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-12)))))).alias("believed"), F.bool_or("good").alias("found"))
        )
        gained = open_edges.join(believed, ["token", "number"]).groupBy(*by, "kind")
        gained = gained.agg(F.count_if("found").alias("instances"), F.sum("believed").alias("believed"))
        both = seeds.unionByName(gained).groupBy(*by, "kind").agg(F.sum("instances").alias("instances"), F.sum("believed").alias("believed"))
        scores, done = scored(both), done + 1


def _beside(limits: dict[str, int]):
    """Different words beside each context in a task's texts, no more than refute the context."""

    def beside(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool: dict[str, set[str]] = {}
        for context in limits:
            words = context[1:].split(" ")
            pool.setdefault(context[0] + words[-1 if context[0] == "<" else 0], set()).add(context)
        anchors = {key[1:] for key in pool}
        found: dict[str, set[str]] = {context: set() for context in limits}
        for batch in batches:
            for text in batch.column(0):
                body = text.as_py() or ""
                lowered = body.lower()
                # digits are normalised, so they cannot be looked for
                if any("0" in a or a in lowered for a in anchors):
                    for context, word in slot_words(body, pool):
                        if len(found[context]) <= limits[context]:
                            found[context].add(word)
        rows = [(context, word) for context, words in found.items() for word in sorted(words)]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], pa.string()) for i in (0, 1)], names=["cue", "word"])

    return beside


def _surviving(texts: DataFrame, contexts: DataFrame) -> DataFrame:
    """``(cue, limit, others)`` of the contexts that the words beside them in ``texts`` do not refute.

    Contexts go to the tasks in parts of some ``AT_ONCE``; there are as many passes as parts.
    """
    spark = texts.sparkSession
    parts = -(-contexts.count() // AT_ONCE)
    kept = None
    for part in range(parts):
        mine = contexts.filter(F.pmod(F.xxhash64("cue"), F.lit(parts)) == part)
        limits = {r["cue"]: r["limit"] for r in mine.select("cue", "limit").toLocalIterator()}
        words = texts.mapInArrow(_beside(limits), "cue string, word string").distinct()
        counted = words.groupBy("cue").agg(F.count("*").alias("others"))
        found = mine.select("cue", "limit").join(counted, "cue", "left").withColumn("others", F.coalesce("others", F.lit(0).cast("long")))
        found = found.filter(F.col("others") <= F.col("limit"))
        kept = found if kept is None else kept.unionByName(found)
    return materialise(kept, "contexts") if kept is not None else spark.createDataFrame([], "cue string, limit long, others long")


def held_against_words(texts: DataFrame, scores: DataFrame, edges: DataFrame) -> DataFrame:
    """``(cue, others)`` of good contexts: how many other words stand beside them, where few do.

    A context of T tokens is refuted by more than ``T / LEAST_SCORE - T`` other words, wherever they
    stand. So a share of the rows refutes most contexts, and only the rest are held against all rows. A
    task gives back no more words of a context than refute it. Refuted contexts count one word more
    than their limit.
    """
    good = scores.filter(_good() & _is_context(F.col("cue"))).select("cue").distinct()
    tokens = edges.groupBy("cue", "number").agg(F.count("*").alias("tokens")).groupBy("cue").agg(F.max("tokens").alias("tokens"))
    limit = F.floor(F.col("tokens") / LEAST_SCORE - F.col("tokens")).cast("long")
    contexts = materialise(good.join(tokens, "cue").select("cue", limit.alias("limit")), "contexts")
    share = texts.filter(F.monotonically_increasing_id() % FIRST_SHARE == 0)
    left = _surviving(share, contexts)
    left = _surviving(texts, left.drop("others")) if not left.isEmpty() else left
    return contexts.join(left.select("cue", "others"), "cue", "left").select("cue", F.coalesce("others", F.col("limit") + 1).alias("others"))


def discovered(scanned: DataFrame, texts: DataFrame) -> DataFrame:
    """``(key, added)``: spans that good cues announce and no expression found.

    Contexts that are good among possible identifiers are held against all words of ``texts(text)``
    beside them. Of two kinds that claim one token, the better scored wins, then the earlier kind.
    """
    cues = scanned.select("key", F.explode("cues").alias("c")).select("key", "c.*")
    edges = materialise(edges_of(cues), "edges")
    scores = cue_scores(edges)
    if not scores.filter(_good() & _is_context(F.col("cue"))).isEmpty():
        scores = cue_scores(edges, held_against_words(texts, scores, edges))
    good = scores.filter(_good()).groupBy("cue").agg(F.min(F.struct(-F.col("score"), F.col("kind").alias("as"))).alias("best"))
    good = good.withColumn("number", F.col("best.as") >= 2)
    tokens = cues.filter((F.col("kind") < 0) & identifier(F.col("token"))).drop("kind")
    hits = tokens.join(good, ["cue", "number"]).groupBy("key", "start", "stop").agg(F.min("best").alias("best"))
    hits = hits.select("key", F.struct(F.col("best.as").alias("kind"), "start", "stop").alias("span"))
    return hits.groupBy("key").agg(F.collect_set("span").alias("added"))


def _listing(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")))
    return F.array_join(text, ",")


def find_documents(docs: DataFrame) -> DataFrame:
    """Personal data of every document; one row per row of ``docs``.

    The expressions' spans are always kept. Nulls: a null text is an empty one, null ids stay.
    Repeated rows are found alike. An empty table gives no rows. Other columns of ``docs`` are not
    read. Cues with too few different seeds are not believed, so small tables add nothing.
    """
    numbered = docs.select(F.struct(F.monotonically_increasing_id().alias("row"), F.col("doc_id")).alias("key"), "text")
    scanned = materialise(scan(numbered, F.col("key")).select("key.*", "base", "cues"), "spans")
    announced = scanned.select(F.col("row").alias("key"), "cues").filter(F.size("cues") > 0)
    added = discovered(announced, docs.select(F.col("text").cast("string").alias("text"))).withColumnRenamed("key", "row")
    out = scanned.select("row", "doc_id", "base").join(added, "row", "left")

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(kind) for kind in range(len(KINDS))]
    every = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.array_union("base", "added")))
    return out.select("doc_id", *counts, F.sha2(_listing(F.col("base")), 256).alias("base_sha256"), _listing(every).alias("spans"))


def masked(text: str, spans: Iterable[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one mark."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced by ``[EMAIL]``, ``[IP]``, ``[CARD]`` and ``[PHONE]``.

    All columns and rows stay; ``n_chars`` follows the text where it is a column. Texts without
    findings are left as they are, null texts too.
    """
    names = docs.columns
    numbered = docs.select(F.struct(*[docs[n] for n in names]).alias("row"), F.monotonically_increasing_id().alias("key"))
    numbered = materialise(numbered, "numbered")
    scanned = materialise(scan(numbered.select("key", F.col("row.text").alias("text")), F.col("key")).filter("size(base) + size(cues) > 0"), "spans")
    added = discovered(scanned.filter(F.size("cues") > 0), numbered.select(F.col("row.text").cast("string").alias("text")))
    spans = scanned.select("key", "base").join(added, "key", "left")
    every = F.array_union("base", F.coalesce("added", F.array().cast("array<struct<kind:int,start:int,stop:int>>")))
    spans = spans.select("key", every.alias("spans")).filter(F.size("spans") > 0)

    @F.udf("string", useArrow=True)
    def mask(text, found):
        return masked(text or "", [(s["kind"], s["start"], s["stop"]) for s in found])

    rows = numbered.join(spans, "key", "left")
    text = F.when(F.col("spans").isNotNull(), mask(F.col("row.text"), F.coalesce("spans", F.array().cast("array<struct<kind:int,start:int,stop:int>>")))).otherwise(F.col("row.text"))
    rows = rows.withColumn("masked", text)
    out = {"text": F.col("masked"), "n_chars": F.when(F.col("spans").isNotNull(), F.length("masked").cast("long")).otherwise(F.col("row.n_chars"))} if "n_chars" in names else {"text": F.col("masked")}
    return rows.select(*[out.get(n, F.col(f"row.`{n}`")).alias(n) for n in names])
