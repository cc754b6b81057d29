"""Personal data by weak supervision, in DataFrame functions only.

Base patterns find e-mail addresses, IP addresses, card and phone numbers.  Looser candidate
patterns find what the base ones miss: a number that runs into its neighbour, a masked
address, an IPv6 address.  Six labelers vote on every span or abstain: the base pattern, the
canonical shape, a checksum or range check, a gazetteer (top-level domains, country codes,
issuer digits, reserved networks), the words before it, and the characters at its edges.
Expectation-maximisation over the counts of vote patterns (a table bounded by the labelers, not
by the corpus) estimates how reliable each labeler is for each kind; the posteriors train a
logistic span classifier, and candidates it accepts that overlap no base span are added.

A pattern's matches are taken with the text between them, so positions are running sums over a
document's matches: linear however many there are.  After the one pass over the texts only
spans move.

Defined results: a null or empty text has no spans (counts 0, empty lists); null ids and
repeated rows keep one result row each; without candidates the base spans are the result; an
empty table gives no rows.  Only the id and text columns are read.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlog.llm.common import store

KINDS = ("email", "ip", "card", "phone")
#: Base patterns: the contract's, with possessive repeats, and looked at only where a run begins
#: (or the last match ended), so that long runs of one class of characters cost linear time.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts without these have no match.
HINT = {"email": r"@[A-Za-z0-9-]++\.", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"(?:[0-9][\x20-]?){11}[0-9]",
        "phone": r"\+[0-9][\x20().0-9-]"}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
LOOSE_HINT = {"email": r"[\[(]at[\])]", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:", "card": HINT["card"],
              "phone": r"[0-9]{3}[\x20.-][0-9]{4}"}
SHAPE = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,}$", "ip": r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$|:",
    "card": r"^[0-9]{16}$|^[0-9]{4}(?:([\x20-])[0-9]{4})(?:\1[0-9]{4}){2}$", "phone": r"^(?:\+[0-9]{1,3}\x20?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}$",
}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
DOMAINS = "com|org|net|edu|gov|info|io|eu|de|fr|es|it|uk|us|ch|at|nl|be|pl|ca|au|br|in|jp|cn"
COUNTRY = r"^\+(?:1|7|2[07]|3[0-4]|36|39|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
WORDS = {"email": "e-?mail|mail|contact|write", "ip": "ip|host|server|address|addr", "card": "card|visa|mastercard|credit|payment|carte|karte|tarjeta",
         "phone": r"phone|tel|telephone|call|mobile|cell|fax|t[eé]l[eé]fono|telefon"}
NOT_WORDS = r"version|v|build|isbn|issn|order|page|section|table|id|no|number|ref"
LABELERS = ("pattern", "shape", "check", "gazetteer", "context", "edges")
NO, YES, ABSTAIN = 0, 1, 2


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add) % 10 == 0


def _matches(text: Column, pattern: str, hint: str, kind: int, base: bool) -> Column:
    """Array of a pattern's matches with the length of the text before each (since the last), and its edges."""
    none = F.array().cast("array<struct<kind:int,base:boolean,nth:int,gap:int,found:string,before:string,after:string>>")
    cut = F.array(F.struct(F.split(text, pattern, -1).alias("parts"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")))
    spans = F.transform(cut, lambda c: F.transform(c["found"], lambda m, i: F.struct(
        F.lit(kind).alias("kind"), F.lit(base).alias("base"), i.alias("nth"), F.length(F.get(c["parts"], i)).alias("gap"), m.alias("found"),
        F.substring(F.get(c["parts"], i), -40, 40).alias("before"), F.substring(F.get(c["parts"], i + 1), 1, 2).alias("after"))))[0]
    return F.when(text.rlike(hint), spans).otherwise(none)


def _spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, span): every match of every pattern; one row without a span for a document without matches."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    every = F.concat(*[_matches(F.col("text"), p[k], h[k], n, base)
                       for p, h, base in ((BASE, HINT, True), (LOOSE, LOOSE_HINT, False)) for n, k in enumerate(KINDS)])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), text.alias("text"))
    return rows.select("row", "id", F.explode_outer(every).alias("span")).select("row", "id", "span.*")


def _by_kind(of: dict[str, Column]) -> Column:
    out = None
    for n, k in enumerate(KINDS):
        out = F.when(F.col("kind") == n, of[k]) if out is None else out.when(F.col("kind") == n, of[k])
    return out


def _voted(spans: DataFrame) -> DataFrame:
    """Valid base spans and candidates with their places and votes."""
    run = Window.partitionBy("row", "kind", "base").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("found")
    placed = spans.filter("kind is not null").withColumn("end", F.sum(F.col("gap") + size).over(run)) \
        .withColumn("start", F.col("end") - size).withColumn("digits", F.regexp_replace("found", "[^0-9]", ""))
    n = F.length("digits")
    # a very long number is no card; its digits are not summed
    luhn = F.when(n.between(12, 19), _luhn(F.col("digits"))).otherwise(F.lit(False))
    in_range = F.col("found").rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    valid = _by_kind({"email": F.lit(True), "ip": in_range, "card": luhn, "phone": n.between(9, 15)})
    placed = placed.withColumn("luhn", luhn).filter(~F.col("base") | valid)
    # candidates that touch no base span
    order = Window.partitionBy("row").orderBy("start", F.col("base").desc(), "end")
    ends = F.max(F.when(F.col("base"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    # the rows after, read backwards: a frame that only grows is summed once, one that shrinks is summed anew at every row
    back = Window.partitionBy("row").orderBy(F.col("start").desc(), F.col("base"), F.col("end").desc())
    begins = F.min(F.when(F.col("base"), F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, -1))
    free = (F.coalesce(ends, F.lit(-1)) <= F.col("start")) & (F.coalesce(begins, F.col("end")) >= F.col("end"))
    placed = placed.withColumn("free", free).filter("base or free")

    def vote(yes: Column, no: Column | None = None) -> Column:
        return F.when(yes, YES).otherwise(F.lit(NO)) if no is None else F.when(yes, YES).when(no, NO).otherwise(ABSTAIN)

    found, before, none = F.col("found"), F.col("before"), F.lit(False)
    octet = F.regexp_extract("found", r"^0*([0-9]{1,3})\.", 1)
    first = F.when(octet != "", octet).cast("int")
    shape = vote(_by_kind({k: found.rlike(SHAPE[k]) for k in KINDS}))
    check = vote(_by_kind({"email": ~found.contains(".."), "ip": in_range | found.contains(":"), "card": F.col("luhn"), "phone": n.between(10, 13)}))
    known = _by_kind({"email": vote(found.rlike(rf"(?i)\.(?:{DOMAINS})$"), none), "ip": vote(first.between(1, 223) | found.contains(":"), first.isNotNull()),
                      "card": vote(found.rlike("^[3-6]")), "phone": vote(found.rlike(COUNTRY), found.startswith("+"))})
    said = _by_kind({k: before.rlike(rf"(?i)\b(?:{WORDS[k]})\b[^A-Za-z0-9]*$") for k in KINDS})
    context = vote(said, before.rlike(rf"(?i)\b(?:{NOT_WORDS})\b[^A-Za-z0-9]*$"))
    edges = vote(~(before.rlike(r"[A-Za-z0-9_=/'\".+-]$") | F.col("after").rlike(r"^(?:[A-Za-z0-9_=/'\"]|[.-][0-9])")))
    votes = {"pattern": vote(F.col("base"), none), "shape": shape, "check": check, "gazetteer": known, "context": context, "edges": edges}
    return placed.select("row", "kind", "base", "start", "end", *[votes[k].alias(k) for k in LABELERS])


#: Yes-rates (true, false spans) that need no estimate: one number in ten passes a check digit by chance.
KNOWN_RATES = {("card", "check"): (0.99, 0.1)}


def reliabilities(counts: dict[tuple[int, ...], int], kind: str = "", rounds: int = 60) -> tuple[dict[tuple[int, ...], float], float, list[tuple[float, float]]]:
    """Posterior of each vote pattern, share of true spans, and (true, false) yes-rates of each labeler."""
    size = len(LABELERS)
    post = {}
    for v in counts:
        cast = [x for x in v if x != ABSTAIN]
        post[v] = (sum(cast) + 0.5) / (len(cast) + 1)
    share, rates = 0.5, [(0.8, 0.2)] * size
    for _ in range(rounds):
        total = sum(counts.values())
        share = (sum(n * post[v] for v, n in counts.items()) + 1) / (total + 2)
        rates = []
        for j in range(size):
            hit = [1.6, 0.4]  # two spans of each class that a fair labeler got right four times in five
            cast = [2.0, 2.0]
            for v, n in counts.items():
                if v[j] != ABSTAIN:
                    for c, w in ((0, post[v]), (1, 1 - post[v])):
                        hit[c] += n * w * v[j]
                        cast[c] += n * w
            rates.append(KNOWN_RATES.get((kind, LABELERS[j]), (hit[0] / cast[0], hit[1] / cast[1])))
        for v in counts:
            odds = math.log(share / (1 - share))
            for j, x in enumerate(v):
                if x != ABSTAIN:
                    t, f = (min(max(r, 1e-4), 1 - 1e-4) for r in rates[j])
                    odds += math.log(t / f) if x == YES else math.log((1 - t) / (1 - f))
            post[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post, share, rates


def _features(kind: int, votes: tuple[int, ...]) -> list[float]:
    return [float(kind == k) for k in range(len(KINDS))] + [float(v == x) for v in votes for x in (NO, YES)]


def train(counts: dict[tuple[int, tuple[int, ...]], int], rounds: int = 300, rate: float = 0.5, penalty: float = 1e-3) -> list[float]:
    """Weights of the span classifier, from the number of spans of each kind and vote pattern."""
    rows = []
    for kind in range(len(KINDS)):
        own = {v: n for (k, v), n in counts.items() if k == kind}
        if own:
            post, _, _ = reliabilities(own, KINDS[kind])
            rows += [(_features(kind, v), post[v], n) for v, n in own.items()]
    weights = [0.0] * len(_features(0, (NO,) * len(LABELERS)))
    total = sum(n for *_, n in rows)
    for _ in range(rounds if rows else 0):
        slope = [0.0] * len(weights)
        for x, target, n in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(weights, x))))))
            for j, a in enumerate(x):
                slope[j] += n / total * (target - p) * a
        weights = [w + rate * len(KINDS) * (s - penalty * w) for w, s in zip(weights, slope)]
    return weights


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(row, id, base, added) of every row of ``docs``: arrays of (start, kind, end) in order of start and
    kind (numbers of ``KINDS``); places in code points, ends exclusive."""
    spans = store(_spans(docs, id_col, text_col), "personal-matches")
    voted = store(_voted(spans), "personal-votes")
    counts = voted.groupBy("kind", *LABELERS).count().collect()  # at most 4 x 3^6 rows
    weights = train({(r["kind"], tuple(r[k] for k in LABELERS)): r["count"] for r in counts})
    terms = [F.when(F.col("kind") == k, weights[k]).otherwise(0.0) for k in range(len(KINDS))]
    terms += [F.when(F.col(name) == x, weights[len(KINDS) + 2 * j + x]).otherwise(0.0) for j, name in enumerate(LABELERS) for x in (NO, YES)]
    logit = sum(terms, F.lit(0.0))
    span = F.struct("start", "kind", "end")
    chosen = voted.withColumn("yes", logit >= math.log(threshold / (1 - threshold))).filter("base or yes")
    lists = chosen.groupBy("row").agg(F.array_sort(F.collect_list(F.when(F.col("base"), span))).alias("base"),
                                      F.array_sort(F.collect_list(F.when(~F.col("base"), span))).alias("added"))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return spans.select("row", "id").distinct().join(lists, "row", "left") \
        .select("row", "id", F.coalesce("base", empty).alias("base"), F.coalesce("added", empty).alias("added"))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
