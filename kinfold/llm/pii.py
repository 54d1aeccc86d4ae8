"""Personal data by candidate generation and gradient-boosted trees, in DataFrame functions only.

The base kinds (email, ip, card, phone) are patterns with checks, and always stay. Beside them, patterns
of high recall propose further spans, which may overlap: obfuscated addresses, IPv6, national phone
numbers, cards whose digits fail the check, social security numbers and IBANs. Each candidate has a
handful of binned features of its format and of the words before it. Trees are boosted on labelled
sentences that this module makes from templates; features being bins, the training data is a count for
each combination of bins, of which there are at most CELLS, and only these go to the driver. The
threshold of each pattern is calibrated on held-out sentences. The trees are applied as CASE expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.common import real_id, texts_of

#: The base patterns. A look-behind or the last match's end starts a match, which saves trying each place of a run.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = ("email", "ip", "card", "phone", "ssn", "iban")
#: What a text must hold for the base patterns to be tried.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
#: Candidate patterns: kind, pattern, a simpler one that a text must hold.
PROPOSED = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64} ?(?:\(at\)|\[at\]|\{at\}| at ) ?[A-Za-z0-9-]{2,63}(?: ?(?:\(dot\)|\[dot\]|\{dot\}| dot |\.) ?[A-Za-z]{2,24}){1,4}", r"[ (\[{]at[ )\]}]"),
    ("ip", r"(?<![0-9A-Za-z:])(?:(?:[0-9a-fA-F]{1,4}:){3,7}[0-9a-fA-F]{1,4}|[0-9a-fA-F]{2,4}(?::[0-9a-fA-F]{1,4}){0,6}::(?:[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){0,6})?)(?![0-9A-Za-z:])", r"[0-9a-fA-F]:[0-9a-fA-F]{0,4}:"),
    ("phone", r"(?<![0-9A-Za-z.+-])(?:(?:00[0-9]{1,3}[ .-]?)?\(?0?[0-9]{2,4}\)?[ ./-]?[0-9]{3,4}[ .-]?[0-9]{3,4}|0[0-9](?:[ .-][0-9]{2}){4})(?![0-9A-Za-z-])", "[0-9]{2}"),
    ("card", r"(?<![0-9A-Za-z.-])[0-9]{4}[ .-]?[0-9]{4}[ .-]?[0-9]{4}[ .-]?[0-9]{1,4}(?![0-9A-Za-z])", "[0-9]{4}[ .-]?[0-9]{4}"),
    ("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9A-Za-z-])", "[0-9]{3}[- ][0-9]{2}[- ]"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}"),
)
#: Words before a candidate that speak for a kind, and words that speak for a mere number.
CUES = (
    r"(?i)\b(?:tel|telephone|phone|call|fax|mobile|cell|dial|whatsapp)\b",
    r"(?i)\b(?:e-?mail|mail|contact|write|reach|address|host|server)\b",
    r"(?i)\b(?:card|visa|mastercard|amex|credit|debit)\b",
    r"(?i)\b(?:ssn|social security|iban|account|bank)\b",
    r"(?i)\b(?:order|invoice|version|build|isbn|ref|serial|model|part|item|time|date|page|total|look|meet|stay|arrive)\b",
)
LEFT = 32
#: Bins of each feature: pattern, digits, separators, cue, checked, brackets, marks.
SIZES = (len(PROPOSED), 7, 4, len(CUES) + 1, 2, 2, 2)
CELLS = math.prod(SIZES)
ROUNDS, RATE, PRECISION = 40, 0.3, 0.995
#: Sentences that are made to learn from, those of a third of the templates held out to calibrate.
SENTENCES = 12_000


def found(text: Column, pattern: str, hint: str) -> Column:
    """array<struct<start, end, s, left>>: matches with code points and what stands before them."""
    shape = "array<struct<start:int,end:int,s:string,left:string>>"
    none = F.array().cast(shape)
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))), matches, lambda g, m: F.struct(g.alias("g"), m.alias("m")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["g"])
        end = start + F.char_length(x["m"])
        left = F.right(F.concat(acc["left"], F.right(x["g"], F.lit(LEFT))), F.lit(LEFT))
        one = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("s"), left.alias("left"))
        return F.struct(end.alias("at"), F.right(F.concat(left, x["m"]), F.lit(LEFT)).alias("left"), F.array_append(acc["out"], one).alias("out"))

    placed = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.lit("").alias("left"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(text.rlike(hint), placed).otherwise(none)


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check of card numbers."""
    places = F.sequence(F.lit(1), F.greatest(F.length(number), F.lit(1)))

    def add(total: Column, i: Column) -> Column:
        d = F.substr(F.reverse(number), i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return (F.length(number) > 0) & (F.aggregate(places, F.lit(0), add) % 10 == 0)


def base(text: Column, kind: str) -> Column:
    """array<struct<k, start, end>> of one base kind, k its number."""
    hits = found(text, BASE[kind], HINTS[kind])
    if kind == "ip":
        ok = lambda x: F.forall(F.split(x["s"], r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.coalesce(F.nullif(F.right(p, F.lit(3)), F.lit("")), F.lit("0")).cast("int") <= 255))
    elif kind == "card":
        ok = lambda x: F.length(digits(x["s"])).between(13, 19) & luhn(digits(x["s"]))
    elif kind == "phone":
        ok = lambda x: F.length(digits(x["s"])).between(9, 15)
    else:
        ok = lambda x: F.lit(True)
    number = KINDS.index(kind)
    return F.transform(F.filter(hits, ok), lambda x: F.struct(F.lit(number).alias("k"), x["start"].alias("start"), x["end"].alias("end")))


def _bin(value: Column, edges: tuple[int, ...]) -> Column:
    out = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        out = F.when(value <= edges[i], i).otherwise(out)
    return out


def features(g: int, x: Column) -> list[Column]:
    """The bins of a candidate of pattern g."""
    number = digits(x["s"])
    cue = F.lit(0)
    for i, pattern in reversed([*enumerate(CUES)]):
        cue = F.when(x["left"].rlike(pattern), i + 1).otherwise(cue)
    return [
        F.lit(g),
        _bin(F.length(number), (6, 8, 10, 12, 15, 19)),
        _bin(F.length(F.regexp_replace(F.trim(x["s"]), "[^ .:/-]", "")), (0, 1, 2)),
        cue,
        luhn(number).cast("int"),
        x["s"].rlike(r"[(\[{]").cast("int"),
        x["s"].rlike(r"(?i)dot|[.:]").cast("int"),
    ]


def proposals(text: Column) -> Column:
    """array<struct<k, start, end, bins array<int>>> of all candidates."""
    def candidate(g: int, kind: str):
        return lambda x: F.struct(F.lit(KINDS.index(kind)).alias("k"), x["start"].alias("start"), x["end"].alias("end"), F.array(*features(g, x)).alias("bins"))

    parts = [F.transform(found(text, pattern, hint), candidate(g, kind)) for g, (kind, pattern, hint) in enumerate(PROPOSED)]
    return F.flatten(F.array(*parts))


#: Templates: the kind of data that the sentence holds or nothing, sentence; # is a digit, ~ a lower-case letter, ^ a capital, * a hexadecimal digit.
TEMPLATES = (
    ("phone", "please call 0##-####### today"), ("phone", "tel (###) ###-#### ext"), ("phone", "phone ###-###-####"), ("phone", "mobile 0### ### ####"),
    ("phone", "phone 0# ## ## ## ##"), ("phone", "call 0#.##.##.##.## now"), ("", "on 0# ## ## ## ## it"), ("", "item 0#-##-##-##-## sold"),
    ("phone", "fax: 00## ### ### ####"), ("phone", "reach me, (###) ###-####"), ("phone", "he gave ###-###-#### as his own"), ("phone", "whatsapp ### ### ####"),
    ("", "order ########## was sent"), ("", "invoice ###-####### total"), ("", "version ###.###.####"), ("", "between #### and #### of them"),
    ("", "isbn ### ####### here"), ("", "part ###-####-### fits"), ("", "they sold ########## units"), ("", "the sum ##### #### rose"), ("", "numbers ####### ####"),
    ("email", "mail ~~~~~.~~~ (at) ~~~~~~ (dot) com"), ("email", "write to ~~~~~~ [at] ~~~~~.org"), ("email", "contact ~~~~##{at}~~~~~~{dot}net"), ("email", "e-mail ~~~~ at ~~~~~ dot com now"),
    ("", "look at ~~~~~.~~~ now"), ("", "we met at ~~~~~~. They left"), ("", "stay at ~~~~~.~~ for it"), ("", "arrive at ~~~~~~ .~~~ on time"), ("", "she sat at ~~~~~. ~~~~ and"),
    ("ip", "host ****:****:****:****:****:****:****:****"), ("ip", "server ****:***:****:****:****:**:****:****"), ("ip", "from ****:****:****:****:****:****:****:**** came"),
    ("ip", "host ****:***::****:***:****"), ("ip", "address fe80::****"), ("ip", "server 2001:db8::****"), ("ip", "reach ****::* now"), ("ip", "2001:***::*** replied"),
    ("", "time ##:##:##:##"), ("", "at ##:##:##:## sharp"), ("", "the ratio #:#:#:# held"), ("", "**:**:**:**:**:** device"),
    ("card", "card ####-####-####-####"), ("card", "visa #### #### #### ####"), ("card", "credit card ################"), ("card", "debit ####.####.####.####"),
    ("", "serial ####-####-####-####"), ("", "ref ################"), ("", "the code ################ ran"), ("", "rows #### #### #### ####"), ("", "model ############# sold"),
    ("ssn", "ssn ###-##-####"), ("ssn", "social security ### ## ####"), ("ssn", "his is ###-##-####"), ("", "item ###-##-####"), ("", "date ### ## ####"), ("", "we saw ### ## #### of them"),
    ("iban", "iban ^^##^^^^################"), ("iban", "account ^^## #### #### #### #### ##"), ("iban", "pay to ^^## #### #### #### ####"),
    ("", "ref ^^##^^^^####"), ("", "model ^^##^^^^####^"), ("", "part ^^## ^^^^ ####"), ("", "the ^^##^^^^^^^^ line"),
)


def sentences(spark: SparkSession, n: int = SENTENCES) -> DataFrame:
    """id, kind (its number, -1 for none), text: sentence `id` is made of its template and a hash of its number, in the same way everywhere."""
    texts = F.array(*[F.lit(t) for _, t in TEMPLATES])
    kinds = F.array(*[F.lit(KINDS.index(k) if k else -1) for k, _ in TEMPLATES])
    row = (F.col("id") % len(TEMPLATES)).cast("int")
    made = spark.range(0, n, 1, 4).select("id", F.get(kinds, row).alias("kind"), F.get(texts, row).alias("t"))

    def char(c: Column, i: Column) -> Column:
        r = F.pmod(F.xxhash64(F.col("id"), i), F.lit(1 << 20)).cast("int")
        pick = lambda letters: F.substring(F.lit(letters), r % len(letters) + 1, F.lit(1))
        cases = F.when(c == "#", pick("0123456789")).when(c == "~", pick("abcdefghijklmnopqrstuvwxyz"))
        return cases.when(c == "^", pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).when(c == "*", pick("0123456789abcdef")).otherwise(c)

    return made.select("id", "kind", F.array_join(F.transform(F.split("t", ""), char), "").alias("text"))


def cells(made: DataFrame, mod: int = 3) -> list[tuple[tuple[int, ...], int, int, int]]:
    """(bins, label, held out, count): at most 4 * CELLS rows. Whole templates are held out, so that the formats
    that thresholds are calibrated on are none that was learnt from."""
    rows = made.select("kind", (F.col("id") % len(TEMPLATES) % mod).cast("int").alias("fold"), F.explode(proposals(F.col("text"))).alias("c"))
    rows = rows.groupBy(F.col("c.bins").alias("bins"), (F.col("c.k") == F.col("kind")).cast("int").alias("label"), (F.col("fold") == 0).cast("int").alias("held")).agg(F.count(F.lit(1)).alias("n"))
    return sorted((tuple(r["bins"]), r["label"], r["held"], r["n"]) for r in rows.collect())


def boost(rows: list, rounds: int = ROUNDS, rate: float = RATE) -> list[tuple]:
    """Trees of two levels on counted cells, logistic loss: (feature, edge, left, right), left and right being (feature, edge, value, value)."""
    data: dict[tuple, list[float]] = {}
    for bins, label, held, n in rows:
        if not held:
            c = data.setdefault(bins, [0.0, 0.0])
            c[label] += n
    cuts = [(f, e) for f, size in enumerate(SIZES) for e in range(size - 1)]
    raw = dict.fromkeys(data, 0.0)
    trees = []

    def best(group: list) -> tuple[float, int, int, float, float]:
        def leaf(part):
            g, h = sum(x[1] for x in part), sum(x[2] for x in part)
            return g * g / (h + 1), g / (h + 1)

        out = (-1.0, 0, SIZES[0], leaf(group)[1], 0.0)
        for f, e in cuts:
            left, right = [x for x in group if x[0][f] <= e], [x for x in group if x[0][f] > e]
            (a, u), (b, v) = leaf(left), leaf(right)
            if a + b > out[0] + 1e-12:
                out = (a + b, f, e, u, v)
        return out

    for _ in range(rounds):
        group = []
        for bins, (n0, n1) in data.items():
            p = 1 / (1 + math.exp(-raw[bins]))
            group.append((bins, n1 * (1 - p) - n0 * p, (n0 + n1) * p * (1 - p)))
        tree = None
        for f, e in cuts:
            left, right = [x for x in group if x[0][f] <= e], [x for x in group if x[0][f] > e]
            if not left or not right:
                continue
            a, b = best(left), best(right)
            if tree is None or a[0] + b[0] > tree[0] + 1e-12:
                tree = (a[0] + b[0], f, e, a[1:], b[1:])
        if tree is None:
            break
        _, f, e, left, right = tree
        trees.append((f, e, (*left[:2], rate * left[2], rate * left[3]), (*right[:2], rate * right[2], rate * right[3])))
        for bins in data:
            raw[bins] += tree_value(trees[-1], bins)
    return trees


def tree_value(tree: tuple, bins) -> float:
    f, e, left, right = tree
    g, d, u, v = left if bins[f] <= e else right
    return u if bins[g] <= d else v


def calibrate(rows: list, trees: list[tuple], precision: float = PRECISION) -> list[float]:
    """For each pattern the least raw score from which held-out candidates reach the precision (infinite if none does)."""
    out = []
    for g in range(len(PROPOSED)):
        scored: dict[float, list[int]] = {}
        for bins, label, held, n in rows:
            if held and bins[0] == g:
                scored.setdefault(round(sum(tree_value(t, bins) for t in trees), 9), [0, 0])[label] += n
        least, good, all_ = math.inf, 0, 0
        for s in sorted(scored, reverse=True):
            good, all_ = good + scored[s][1], all_ + sum(scored[s])
            if all_ and good / all_ >= precision:
                least = s
        out.append(max(least, 0.0))
    return out


_FITTED: dict[int, tuple[list, list]] = {}


def fitted(spark: SparkSession) -> tuple[list, list]:
    """Trees and thresholds; they depend on this module's sentences only and are kept for the process."""
    if SENTENCES not in _FITTED:
        rows = cells(sentences(spark))
        trees = boost(rows)
        _FITTED[SENTENCES] = trees, calibrate(rows, trees)
    return _FITTED[SENTENCES]


def _score(trees: list[tuple], bins: Column) -> Column:
    total = F.lit(0.0)
    for f, e, left, right in trees:
        leaf = [F.when(bins[side[0]] <= side[1], side[2]).otherwise(side[3]) for side in (left, right)]
        total = total + F.when(bins[f] <= e, leaf[0]).otherwise(leaf[1])
    return total


def selected(good: Column) -> Column:
    """array<struct<k, start, end>>: best first, the candidates that overlap none selected before."""
    order = F.sort_array(F.transform(good, lambda c: F.struct(c["score"].alias("score"), (c["end"] - c["start"]).alias("n"), (-c["start"]).alias("a"), (-c["k"]).alias("b"))), asc=False)
    spans = F.transform(order, lambda c: F.struct((-c["b"]).alias("k"), (-c["a"]).alias("start"), (c["n"] - c["a"]).alias("end")))

    def step(acc: Column, c: Column) -> Column:
        return F.when(F.exists(acc, lambda o: (o["start"] < c["end"]) & (c["start"] < o["end"])), acc).otherwise(F.array_append(acc, c))

    return F.aggregate(spans, F.array().cast("array<struct<k:int,start:int,end:int>>"), step)


def added(text: Column, known: Column, model: tuple[list, list]) -> Column:
    """array<struct<k, start, end>>: candidates that the trees accept and that overlap no known span and no better one selected."""
    trees, least = model
    floor = F.array(*[F.lit(min(x, 1e9)) for x in least])
    scored = F.transform(proposals(text), lambda c: F.struct(_score(trees, c["bins"]).alias("score"), c["k"].alias("k"), c["start"].alias("start"), c["end"].alias("end"), floor[c["bins"][0]].alias("floor")))
    good = F.filter(scored, lambda c: (c["score"] >= c["floor"] - 1e-6) & ~F.exists(known, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))

    return selected(good)


def detect(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """Adds one column `into` to docs: a struct of n_email, n_ip, n_card, n_phone, base and spans (arrays of k, start,
    end by k, then start).

    All other columns and rows stay as they are; a column `into` that docs has already is refused. Null and empty texts
    have no spans; repeated rows get equal ones; texts of any length are read whole. Of overlapping candidates that are
    accepted the best stays, of equal scores the longer, then the earlier one. An empty table gives an empty result.
    """
    if into in docs.columns:
        raise ValueError(f"there is a column {into} already")
    model = fitted(docs.sparkSession)
    own = F.coalesce(F.col(text), F.lit(""))
    mark = "_" * (1 + max([0, *(len(c) for c in docs.columns)]))  # no column's name begins like this
    out = docs
    for kind in BASE:
        out = out.withColumn(mark + kind, base(own, kind))
    out = out.withColumn(mark + "base", F.concat(*[F.col(mark + kind) for kind in BASE]))
    out = out.withColumn(mark + "spans", F.array_sort(F.concat(mark + "base", added(own, F.col(mark + "base"), model))))
    counts = [F.size(mark + kind).cast("long").alias(f"n_{kind}") for kind in BASE]
    return out.select(*docs.columns, F.struct(*counts, F.col(mark + "base").alias("base"), F.col(mark + "spans").alias("spans")).alias(into))


def printed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans as the name of the first in brackets."""
    names = F.array(*[F.lit(k.upper()) for k in KINDS])
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["k"].alias("k"))))
    shape = "array<struct<start:int,end:int,k:int>>"

    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"), last["k"].alias("k"))
        return F.when((F.size(acc) > 0) & (x["start"] < last["end"]), F.array_append(F.slice(acc, 1, F.size(acc) - 1), joined)).otherwise(F.array_append(acc, x))

    runs = F.aggregate(order, F.array().cast(shape), step)

    def put(runs: Column) -> Column:
        before = lambda i: F.when(i == 0, 0).otherwise(F.get(runs, i - 1)["end"])
        parts = F.transform(runs, lambda x, i: F.concat(F.substring(text, before(i) + 1, x["start"] - before(i)), F.lit("["), F.get(names, x["k"]), F.lit("]")))
        tail = F.substring(text, F.try_element_at(runs, F.lit(-1))["end"] + 1, F.char_length(text))
        return F.concat(F.array_join(parts, ""), tail)

    return F.when(F.size(spans) > 0, F.get(F.transform(F.array(runs), put), F.lit(0))).otherwise(text)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts, base_sha256 and spans as printed of every row; null texts are empty, repeated rows alike."""
    out = detect(texts_of(docs))
    return out.select(real_id(), *[f"pii.n_{k}" for k in BASE], F.sha2(printed(F.col("pii.base")), 256).alias("base_sha256"), printed(F.col("pii.spans")).alias("spans"))
