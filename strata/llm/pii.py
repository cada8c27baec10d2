"""Personal data: patterns, gazetteers and contexts vote, a model weighs the votes.

Four kinds are found: email, ip, card, phone. Each has a strict form, whose
matches that pass its test (parts of an address, Luhn's sum, number of digits) are
always reported, and a loose form (spelled-out addresses, defanged or long
addresses, other separators, no country code), whose matches are candidates.

Labelers vote on every candidate, strict or loose: for, against, or not at all.

* form: the strict test; for a loose match, the strict spans it overlaps (for it if one is of
  its kind, against it if all are of others);
* loose: the loose form's own test;
* gazetteer: known top-level domains, issuer prefixes, calling codes, ranges of
  addresses that belong to nobody;
* context: words before the span in four languages;
* borders: whether the span is glued to letters, digits or underscores.

What the strict form says is settled: its spans are reported, its failed matches
are not. Expectation-maximisation finds, per kind, how reliable the other labelers
are, from the settled candidates and from how they agree on the rest. Its
posteriors train the span classifier, a logistic model over the votes and the
span's shape, and loose candidates on which the strict form has no vote go in
when the classifier is sure of them.

Everything that touches texts is an expression of built-in functions: the matches
of a pattern come from ``regexp_extract_all``, what lies between them from
``split``, and the running sum of their lengths gives the places, in code points.
There is no shuffle of texts. What the model is fitted on is the table of
distinct (kind, votes, shape) with counts over all candidates; its size is
bounded by the number of such combinations (``MOST_PATTERNS``), whatever the
number of documents.

Null texts count as empty. Rows that repeat stay apart; other columns are not
read; an empty table gives no rows. Texts are searched whole; patterns are
written so that no match needs recursion or takes more than linear time.
"""

from __future__ import annotations

from functools import reduce
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

KINDS = ("email", "ip", "card", "phone")

# The strict forms. Places where a match can begin are said by what stands before, and loops do
# not give back what they took, which changes no match and keeps the search linear.
LOCAL = "A-Za-z0-9._%+-"
STRICT = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:\x20?[(\[{]\x20?(?:at|AT|@)\x20?[)\]}]\x20?|\x20(?:at|AT)\x20)"
_DOT = r"(?:\x20?[(\[{]\x20?(?:dot|DOT|\.)\x20?[)\]}]\x20?|\x20(?:dot|DOT)\x20)"
LOOSE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "ip": (r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
           r"|(?<![0-9])[0-9]{1,3}(?:[\[(]\.[\])][0-9]{1,3}){3}(?![0-9])"),
    "card": r"(?<![0-9])[0-9]{4}([._/\t])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])",
    "phone": r"(?<![0-9+.])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])"
             r"[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9]|\.[0-9])",
}
#: What a text must hold for a pattern to be tried at all.
GUARDS = {
    ("email", True): "@", ("ip", True): r"[0-9]\.[0-9]", ("card", True): "[0-9]",
    ("phone", True): r"\+[0-9]", ("email", False): r"[\x20(\[{](?:dot|DOT|\.)[\x20)\]}]",
    ("ip", False): r"[0-9A-Fa-f]:[0-9A-Fa-f]|\.[\])][0-9]", ("card", False): r"[0-9][._/\t][0-9]",
    ("phone", False): r"[0-9)][\x20.-][0-9]",
}

# Gazetteers (fixed values).
DOMAINS = ("com org net edu gov mil int info biz io co ai app dev eu us uk de fr es it nl be ch "
           "at pt pl ru cn jp in br mx ca au").split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[4-9]|6(?:011|4[4-9]|5)|62)"
CALLING = (r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|"
           r"2[1-69][0-9]|3[578][0-9]|42[013]|5[09][0-9]|6[7-9][0-9]|8[05-8][0-9]|9[679][0-9])")
NOBODY = r"^0*(?:0|10|127|169\.0*254|192\.0*168|22[4-9]|2[34][0-9]|25[0-5])\."
CONTEXT = {
    "email": r"mail|courriel|correo|contact|kontakt|write\s+to|schreib|[ée]crire|escrib",
    "ip": r"\bip\b|\bipv[46]\b|server|host|address|adresse|direcci",
    "card": r"card|visa|master|amex|credit|karte|carte|tarjeta|cr[ée]dit",
    "phone": r"tel\b|t[ée]l[ée]?f|phone|call|fax|mobile|cell|anruf|appel|llam|m[óo]vil|handy",
}
AGAINST = (r"version|release|build|isbn|issn|order|invoice|serial|token|hash|"
           r"bestell|rechnung|commande|facture|pedido|factura")

#: Code points of text before a span that its context is read from.
CONTEXT_CHARS = 40
#: Probability from which a loose candidate is added.
SURE = 0.9
#: Spans whose lengths are summed in one go.
BLOCK = 256

AGAINST_IT, NO_VOTE, FOR_IT = 0, 1, 2
VOTES = ("form", "loose", "gazetteer", "context", "borders")
#: Shape of a span, as small numbers: values per field.
SHAPE = {"size": 8, "marks": 4}
FIELDS = {**{v: 3 for v in VOTES}, **SHAPE}
MOST_PATTERNS = len(KINDS) * 3 ** len(VOTES) * 8 * 4
# What is assumed of a labeler before any candidate is seen, in candidates per vote (against,
# none, for), on false and on true spans; and of the share of true spans among the unsettled.
BEFORE = ((10.0, 5.0, 1.0), (1.0, 5.0, 10.0))
BEFORE_FALSE, BEFORE_TRUE = 19.0, 1.0


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _running(values: Column, start: Column) -> Column:
    """Exclusive running sums of an array of longs from ``start``."""
    begin = F.struct(start.alias("t"), F.array().cast("array<long>").alias("o"))
    return F.aggregate(
        values, begin,
        lambda a, x: F.struct((a["t"] + x).alias("t"),
                              F.concat(a["o"], F.array(a["t"])).alias("o")),
        lambda a: a["o"])


def _blocks(values: Column) -> Column:
    """An array cut to arrays of ``BLOCK`` values (null for none)."""
    last = F.floor((F.size(values) - 1) / BLOCK).cast("int")
    return F.when(F.size(values) > 0, F.transform(
        F.sequence(F.lit(0), last), lambda b: F.slice(values, b * BLOCK + 1, BLOCK)))


def _located(df: DataFrame, patterns: list[tuple[str, str, Column]]) -> DataFrame:
    """Per (name, pattern, guard) a column ``name``: array of start, end, word,
    before, after of the matches in ``text``, leftmost and without overlaps.

    Each step is a column of its own, so that no search is done twice. Running
    sums go block by block: their cost grows with the matches, not with their square.
    """
    def step(frame: DataFrame, **columns) -> DataFrame:
        return frame.select("*", *[c.alias(n) for n, c in columns.items()])

    names = [n for n, _, _ in patterns]
    kept = [c for c in df.columns if c != "text"]
    df = step(df, **{f"{n}_m": F.when(g, F.regexp_extract_all("text", F.lit(p), F.lit(0)))
                     for n, p, g in patterns})
    df = step(df, **{f"{n}_r": F.when(F.size(f"{n}_m") > 0, F.split("text", p, -1))
                     for n, p, _ in patterns})
    df = df.drop("text")
    df = step(df, **{f"{n}_l": F.zip_with(
        F.slice(f"{n}_r", 1, F.size(f"{n}_m")), f"{n}_m",
        lambda r, m: (F.length(r) + F.length(m)).cast("long")) for n in names})
    df = step(df, **{f"{n}_b": _blocks(F.col(f"{n}_l")) for n in names})
    df = step(df, **{f"{n}_s": _running(F.transform(f"{n}_b", _sum), F.lit(0).cast("long"))
                     for n in names})
    df = step(df, **{f"{n}_o": F.flatten(F.zip_with(f"{n}_b", f"{n}_s", _running))
                     for n in names})

    def spans(n: str) -> Column:
        words, rest, places = F.col(f"{n}_m"), F.col(f"{n}_r"), F.col(f"{n}_o")

        def span(i: Column) -> Column:
            start = places[i] + F.length(rest[i])
            return F.struct(
                start.alias("start"), (start + F.length(words[i])).alias("end"),
                words[i].alias("word"),
                F.lower(F.right(rest[i], F.lit(CONTEXT_CHARS))).alias("before"),
                F.left(rest[i + 1], F.lit(1)).alias("after"))

        return F.when(F.size(words) > 0, F.transform(
            F.sequence(F.lit(0), F.size(words) - 1), span))

    return df.select(*kept, *[F.coalesce(spans(n), F.array()).alias(n) for n in names])


def _digits(word: Column) -> Column:
    return F.regexp_replace(word, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def value(i: Column) -> Column:
        d = F.substr(back, i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when(i % 2 == 0, twice).otherwise(d).cast("long")

    return _sum(F.transform(F.sequence(F.lit(1), F.length(digits)), value)) % 10 == 0


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


def _passes(kind: str, is_strict: bool, word: Column) -> Column:
    """The test of a form."""
    digits, n = _digits(word), F.length(_digits(word))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        if is_strict:
            return word.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
        plain = F.translate(word, "[]()", "")
        return word.contains(":") | plain.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    if kind == "card":
        return F.when(n.between(14 if is_strict else 16, 19 if is_strict else 16),
                      _luhn(digits)).otherwise(F.lit(False))
    if is_strict:
        return n.between(10, 15)
    return n.between(10, 11) | (word.startswith("+") & n.between(10, 14))


def _known(kind: str, is_strict: bool, word: Column) -> Column:
    """The gazetteer's vote."""
    if kind == "email":
        ending = F.lower(F.regexp_extract(word, "[A-Za-z0-9-]+$", 0))
        return F.when(ending.isin(DOMAINS), FOR_IT).otherwise(AGAINST_IT)
    if kind == "ip":
        plain = F.translate(word, "[]()", "")
        return F.when(plain.contains(":"), NO_VOTE).when(plain.rlike(NOBODY), AGAINST_IT).otherwise(
            FOR_IT)
    if kind == "card":
        return F.when(_digits(word).rlike(ISSUERS), FOR_IT).otherwise(AGAINST_IT)
    if not is_strict:
        return F.lit(NO_VOTE)
    return F.when(_digits(word).rlike(CALLING), FOR_IT).otherwise(AGAINST_IT)


def _candidate(kind: str, is_strict: bool, span: Column) -> Column:
    """Votes and shape of one match."""
    word, before = span["word"], span["before"]
    passes = _passes(kind, is_strict, word)
    vote = F.when(passes, FOR_IT).otherwise(AGAINST_IT)
    context = (F.when(before.rlike(CONTEXT[kind]), FOR_IT).when(before.rlike(AGAINST), AGAINST_IT)
               .otherwise(NO_VOTE))
    glued = F.right(before, F.lit(1)).rlike(r"[\p{L}0-9_]") | span["after"].rlike(r"[\p{L}0-9_]")
    marks = F.length(F.regexp_replace(word, r"[\p{L}0-9]", ""))
    size = F.floor(F.log2(F.length(word).cast("double")))
    return F.struct(
        span["start"].alias("start"), span["end"].alias("end"),
        F.lit(KINDS.index(kind)).alias("kind"),
        (F.lit(is_strict) & passes).alias("base"),
        (vote if is_strict else F.lit(NO_VOTE)).alias("form"),
        (F.lit(NO_VOTE) if is_strict else vote).alias("loose"),
        _known(kind, is_strict, word).alias("gazetteer"), context.alias("context"),
        F.when(glued, AGAINST_IT).otherwise(FOR_IT).alias("borders"),
        F.least(size, F.lit(SHAPE["size"] - 1)).cast("int").alias("size"),
        F.least(F.floor(F.log2((marks + 1).cast("double"))), F.lit(SHAPE["marks"] - 1))
        .cast("int").alias("marks"))


def _overlaps(span: Column, blocks: Column, of_kind: bool) -> Column:
    """Whether a span overlaps one of the sorted spans in ``blocks`` (null: none)."""
    def one(b: Column) -> Column:
        same = (b["start"] < span["end"]) & (span["start"] < b["end"])
        return same & (b["kind"] == span["kind"]) if of_kind else same

    found = F.exists(blocks, lambda k: (k["low"] < span["end"]) & (span["start"] < k["high"])
                     & F.exists(k["spans"], one))
    return F.coalesce(found, F.lit(False))


def candidates(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, spans: per row of ``df`` all matches of all forms with votes and shape."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    forms = [(k, s) for s in (True, False) for k in KINDS]

    def name(kind: str, is_strict: bool) -> str:
        return f"{'strict' if is_strict else 'loose'}_{kind}"

    found = _located(rows, [
        (name(k, s), (STRICT if s else LOOSE)[k], F.col("text").rlike(GUARDS[k, s]))
        for k, s in forms])

    def judged(kind: str, is_strict: bool) -> Column:
        return F.transform(name(kind, is_strict), lambda x: _candidate(kind, is_strict, x))

    sides = found.select("doc_id", *[
        F.concat(*[judged(k, s) for k, s in forms if s == is_strict]).alias(side)
        for side, is_strict in (("strict", True), ("loose", False))])
    sides = sides.withColumn("base", _blocks(F.array_sort(F.transform(
        F.filter("strict", lambda x: x["base"]),
        lambda x: F.struct(x["start"], x["end"], x["kind"])))))
    sides = sides.withColumn("base", F.transform("base", lambda b: F.struct(
        b[0]["start"].alias("low"), F.array_max(F.transform(b, lambda x: x["end"])).alias("high"),
        b.alias("spans"))))

    def settled(span: Column) -> Column:
        base = F.col("base")
        return span.withField("form", F.when(_overlaps(span, base, True), FOR_IT).when(
            _overlaps(span, base, False), AGAINST_IT).otherwise(NO_VOTE))

    return sides.select("doc_id", F.concat("strict", F.transform("loose", settled)).alias("spans"))


Pattern = tuple[int, ...]


def vote_table(found: DataFrame) -> dict[Pattern, int]:
    """(kind, votes, shape) -> number of candidates; at most ``MOST_PATTERNS`` entries."""
    each = found.select(F.explode("spans").alias("s")).select("s.*")
    counts = each.groupBy("kind", *FIELDS).count()
    return {tuple(r)[:-1]: r[-1] for r in counts.collect()}


def reliabilities(votes: dict[tuple[int, ...], int],
                  rounds: int = 50) -> tuple[float, list, dict[tuple[int, ...], float]]:
    """Expectation-maximisation over one kind's votes: share of true spans among the
    unsettled, per labeler the chances of its votes on false and true spans, and the
    posterior of every pattern. Settled patterns keep what the strict form says.
    """
    settled = {v: v[0] == FOR_IT for v in votes if v[0] != NO_VOTE}
    prior = BEFORE_TRUE / (BEFORE_TRUE + BEFORE_FALSE)
    chances = [[[m / sum(mass) for m in mass] for mass in BEFORE] for _ in VOTES]
    posterior: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for v in votes:
            odds = log(prior / (1 - prior)) + sum(
                log(chances[at][1][x] / chances[at][0][x]) for at, x in enumerate(v) if at)
            posterior[v] = float(settled[v]) if v in settled else 1 / (1 + exp(-odds))
        unsettled = [(n, posterior[v]) for v, n in votes.items() if v not in settled]
        true = sum(n * p for n, p in unsettled) + BEFORE_TRUE
        prior = true / (sum(n for n, _ in unsettled) + BEFORE_TRUE + BEFORE_FALSE)
        for at in range(len(VOTES)):
            for is_true in (False, True):
                mass = list(BEFORE[is_true])
                for v, n in votes.items():
                    mass[v[at]] += n * (posterior[v] if is_true else 1 - posterior[v])
                chances[at][is_true] = [m / sum(mass) for m in mass]
    return prior, chances, posterior


def classifier(patterns: dict[tuple[int, ...], int], posterior: dict[tuple[int, ...], float],
               rounds: int = 300, shrink: float = 1.0) -> tuple[float, list[list[float]]]:
    """Logistic weights per value of every field, trained on the posteriors.

    Every weight goes along its slope by a step that suits how many candidates it
    has (the curvature of a weight is at most a quarter of them, for each of the
    weights that act together), so that rare values are learnt as well as frequent
    ones. Weights are shrunk towards none.
    """
    bias, weights = 0.0, [[0.0] * n for n in FIELDS.values()]
    total = sum(patterns.values())
    number = [[sum(n for p, n in patterns.items() if p[f] == v) for v in range(size)]
              for f, size in enumerate(FIELDS.values())]
    together = (len(FIELDS) + 1) / 4
    for _ in range(rounds):
        slope_bias, slopes = 0.0, [[0.0] * n for n in FIELDS.values()]
        for p, n in patterns.items():
            z = bias + sum(weights[f][v] for f, v in enumerate(p))
            miss = n * (posterior[p[:len(VOTES)]] - 1 / (1 + exp(-max(-500.0, min(500.0, z)))))
            slope_bias += miss
            for f, v in enumerate(p):
                slopes[f][v] += miss
        bias += slope_bias / (together * total)
        for f, slope in enumerate(slopes):
            for v, s in enumerate(slope):
                weights[f][v] += ((s - shrink * weights[f][v])
                                  / (together * number[f][v] + shrink))
    return bias, weights


class SpanModel:
    """Reliabilities and span classifier of every kind."""

    def __init__(self, table: dict[Pattern, int]):
        self.reliabilities: dict[str, tuple[float, list]] = {}
        self.classifiers: dict[str, tuple[float, list[list[float]]]] = {}
        for at, kind in enumerate(KINDS):
            own = {p[1:]: n for p, n in table.items() if p[0] == at}
            if not own:
                continue
            votes: dict[tuple[int, ...], int] = {}
            for p, n in own.items():
                votes[p[:len(VOTES)]] = votes.get(p[:len(VOTES)], 0) + n
            prior, chances, posterior = reliabilities(votes)
            self.reliabilities[kind] = prior, chances
            self.classifiers[kind] = classifier(own, posterior)

    def probability(self, span: Column) -> Column:
        """Chance that a candidate is personal data (0 for a kind without a model)."""
        out = F.lit(0.0)
        for kind, (bias, weights) in self.classifiers.items():
            z = reduce(Column.__add__, [
                F.element_at(F.array(*map(F.lit, w)), span[f] + 1)
                for f, w in zip(FIELDS, weights, strict=True)], F.lit(bias))
            out = F.when(span["kind"] == KINDS.index(kind), 1 / (1 + F.exp(-z))).otherwise(out)
        return out


class Findings:
    """``rows``: doc_id, base and spans (arrays of start, kind, end), in text order."""

    def __init__(self, df: DataFrame, id_col: str, text_col: str, sure: float = SURE):
        self.candidates = materialize(candidates(df, id_col, text_col), "pii-candidates")
        self.model = SpanModel(vote_table(self.candidates))
        self.rows = self._rows(sure)

    def _rows(self, sure: float) -> DataFrame:
        def place(s: Column) -> Column:
            return F.struct(s["start"].alias("start"), s["kind"].alias("kind"),
                            s["end"].alias("end"))

        def reported(s: Column) -> Column:
            added = ((s["form"] == NO_VOTE) & (s["loose"] == FOR_IT)
                     & (self.model.probability(s) >= sure))
            return s["base"] | added

        return self.candidates.select("doc_id", *[
            F.array_sort(F.transform(F.filter("spans", keep), place)).alias(name)
            for name, keep in (("base", lambda s: s["base"]), ("spans", reported))])


def find_personal_data(df: DataFrame, id_col: str, text_col: str, sure: float = SURE) -> Findings:
    """Fit on all candidates of ``df`` and report the spans of every row."""
    return Findings(df, id_col, text_col, sure)


def written(spans: str) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def number_of(kind: str, spans: str) -> Column:
    at = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == at)).cast("long")
