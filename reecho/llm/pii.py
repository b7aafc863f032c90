"""Personal data by candidate boosting, in DataFrame functions only.

Wide generators propose spans, which may overlap; each has a fixed strict form, whose matches always stay, and looser
ones. Boosted trees judge the loose candidates by format and context. They are fitted on counts of feature
patterns over all documents, with the strict forms' own checks as labels, and on labelled phrases; thresholds are
calibrated on held-out patterns to a wanted precision.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reecho.llm import boosting
from reecho.operators.documents import computed_once
from reecho.workspace import Workspace

KINDS = ("email", "ip", "card", "phone")

# The strict forms. Possessive loops and guarded starts match the same spans as the plain
# patterns, without their deep recursion and quadratic retries.
_LOCAL = r"[A-Za-z0-9._%+-]"
STRICT = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

LOOSE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\]|\{at\}|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?(?:\(dot\)|\[dot\]|\{dot\}|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}){1,5}",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
    r"|(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){1,6}|:)(?::[0-9A-Fa-f]{1,4}){1,6}(?![0-9A-Za-z:])|(?<![0-9.\[])[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9.-])[0-9](?:[\x20.-]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,5}\)?(?:[\x20./-]{1,2}[0-9]{2,5}){1,4}(?![0-9A-Za-z])",
}

# Digits in groups, which may hold a card and more: a card is looked for from each group's start to each group's end.
CARD_RUN = r"(?<![0-9.-])[0-9](?:[\x20.-]?[0-9]){12}(?:[\x20.-]?[0-9])*+"
CARD_DIGITS = range(13, 20)

# Words before a candidate that speak for a kind, or against all of them.
HINTS = {
    "email": "mail|contact|write|reach",
    "ip": r"\bip\b|host|server|address|node|ping",
    "card": "card|visa|master|amex|credit|debit|payment|pay",
    "phone": r"phone|\btel|call|mobile|\bfax|cell|dial|whatsapp|sms",
}
AGAINST = r"order|invoice|isbn|version|\bv\.?$|date|\bref|serial|\bid\b|number of|page|\bno\.?\s*$|section|total|sku|code"

FEATURES = ("kind", "loose", "digits", "groups", "checked", "opening", "separators", "hint", "against", "before", "after")


@dataclass(frozen=True)
class PiiParams:
    """``patterns``: at most that many distinct feature patterns, the commonest, are used for the fit."""

    precision: float = 0.95
    patterns: int = 50_000
    trees: int = 24
    depth: int = 3
    context: int = 24


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _passes(kind: str, value: Column) -> Column:
    """The strict check of a strict match."""
    count = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.when(count.between(16, 19), F.call_function("luhn_check", _digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return count.between(8, 15)
    return F.lit(True)


def _plausible(kind: str, value: Column) -> Column:
    """Whether a match is a candidate at all."""
    count = F.length(_digits(value))
    # shortened IPv6 addresses have at most seven groups
    groups = F.size(F.filter(F.split(value, ":"), lambda group: group != ""))
    address = ~value.contains("::") | (groups <= 7)
    return {"ip": address, "card": count.between(13, 19), "phone": count.between(7, 15)}.get(kind, F.lit(True))


def _may_hold(kind: str, loose: int, text: Column) -> Column:
    """A cheap test that every text with a match of the pattern passes."""
    digit = text.rlike("[0-9]")
    guards = {
        ("email", 0): text.contains("@"),
        ("email", 1): text.rlike(r"(?i)\(at\)|\[at\]|\{at\}|\x20at\x20") & text.rlike(r"(?i)\(dot\)|\[dot\]|\{dot\}|\x20dot\x20"),
        ("ip", 0): text.rlike(r"[0-9]\.[0-9]"),
        ("ip", 1): text.contains("[.]") | text.contains("::") | text.rlike("[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:"),
        ("phone", 0): text.rlike(r"\+[0-9]"),
    }
    return guards.get((kind, loose), digit)


def located(text: Column, pattern: str, keep, describe, guard: Column) -> Column:
    """Array of described matches with code-point offsets, for matches that ``keep`` holds for. Texts without the ``guard`` have none."""
    matches, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.zip_with(pieces, matches, lambda piece, match: F.struct(F.length(piece).alias("skip"), match.alias("value")))
    element = describe(F.lit(0), F.lit(0), F.lit(""))
    state = F.struct(F.lit(0).alias("at"), F.slice(F.array(element), 1, 0).alias("found"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + pair["skip"]
        end = start + F.length(pair["value"])
        grown = F.concat(acc["found"], F.array(describe(start, end, pair["value"])))
        return F.struct(end.alias("at"), F.when(keep(pair["value"]), grown).otherwise(acc["found"]).alias("found"))

    # the last piece follows the last match, so it has none
    found = F.aggregate(F.filter(pairs, lambda p: p["value"].isNotNull()), state, step, lambda acc: acc["found"])
    return F.when(guard & text.rlike(pattern), found).otherwise(F.slice(F.array(element), 1, 0))


def card_parts(text: Column, describe) -> Column:
    """Runs of 13 to 19 digits that pass Luhn, from any group's start to any group's end of longer runs; they overlap."""
    described = lambda start, end, value: F.struct(start.alias("start"), value.alias("value"))
    runs = located(text, CARD_RUN, lambda value: F.lit(True), described, _may_hold("card", 1, text))

    def parts(run: Column) -> Column:
        value = run["value"]
        starts = F.filter(
            F.sequence(F.lit(1), F.length(value)), lambda i: (i == 1) | F.substring(value, i - 1, F.lit(1)).isin(" ", ".", "-")
        )

        def ending(i: Column) -> Column:
            ahead = F.substring(value, i, F.lit(2 * CARD_DIGITS[-1]))
            found = [F.regexp_extract(ahead, rf"^[0-9](?:[\x20.-]?[0-9]){{{n - 1}}}(?![0-9])", 0) for n in CARD_DIGITS]
            valid = F.filter(F.array(*found), lambda part: (part != "") & F.call_function("luhn_check", _digits(part)))
            at = run["start"] + i - 1
            return F.transform(valid, lambda part: describe(at, at + F.length(part), part))

        return F.flatten(F.transform(starts.cast("array<int>"), ending))

    return F.flatten(F.transform(runs, parts))


def candidates(text: Column, generators: tuple[int, ...] = (0, 1)) -> Column:
    """All spans that strict (0) and loose (1) generators propose: ``(kind, loose, start, end, value, checked)``; kind by its place in ``KINDS``."""
    proposed = []
    for number, kind in enumerate(KINDS):
        for loose in generators:
            def describe(start: Column, end: Column, value: Column, number=number, loose=loose, kind=kind) -> Column:
                if loose:
                    checked = F.call_function("luhn_check", _digits(value)) if kind == "card" else F.lit(False)
                else:
                    checked = _passes(kind, value)
                return F.struct(
                    F.lit(number).alias("kind"), F.lit(loose).alias("loose"), start.alias("start"), end.alias("end"),
                    value.alias("value"), F.coalesce(checked, F.lit(False)).alias("checked"),
                )

            pattern = (STRICT, LOOSE)[loose][kind]
            found = located(text, pattern, lambda value, kind=kind: _plausible(kind, value), describe, _may_hold(kind, loose, text))
            if loose and kind == "card":
                found = F.array_distinct(F.concat(found, card_parts(text, describe)))
            proposed.append(found)
    return F.concat(*proposed)


def described(text: Column, span: Column, params: PiiParams) -> Column:
    """A candidate with its binned features."""
    value, start, end = span["value"], span["start"], span["end"]
    length = F.least(start, F.lit(params.context))
    before = F.lower(F.substring(text, start - length + 1, length))
    after = F.substring(text, end + 1, F.lit(1))
    number = F.length(_digits(value))
    def sort_of(char: Column) -> Column:
        return F.when(char == "", 0).when(char.rlike(r"\s"), 1).when(char.rlike(r"[\p{L}\p{N}]"), 2).otherwise(3)

    hint = F.lit(0)
    for i, words in enumerate(HINTS.values()):
        hint = F.when(before.rlike(words) & (span["kind"] == i), 2).when(before.rlike(words), F.greatest(hint, F.lit(1))).otherwise(hint)
    features = {
        "kind": span["kind"],
        "loose": span["loose"],
        "digits": F.when(number < 8, 0).when(number < 10, 1).when(number < 12, 2).when(number < 13, 3).when(number < 16, 4).when(number < 17, 5).otherwise(6),
        "groups": F.least(F.size(F.split(value, "[^0-9A-Za-z]+")), F.lit(8)),
        "checked": span["checked"].cast("int"),
        "opening": F.when(value.startswith("+"), 1).when(value.startswith("("), 2).when(value.startswith("0"), 3).otherwise(0),
        "separators": F.when(value.contains("/"), 4).when(value.contains("-"), 3).when(value.contains("."), 2).when(value.contains(" "), 1).otherwise(0),
        "hint": hint,
        "against": before.rlike(AGAINST).cast("int"),
        "before": sort_of(F.right(before, F.lit(1))),
        "after": sort_of(after),
    }
    return F.struct(
        span["start"].alias("start"), span["end"].alias("end"), span["checked"].alias("strict_ok"),
        *[features[name].cast("int").alias(f"f_{name}") for name in FEATURES],
    )


def with_candidates(docs: DataFrame, params: PiiParams, generators: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Adds ``spans``, the described candidates; keeps the other columns."""
    proposed = computed_once(docs, "proposed", candidates(F.col("text"), generators))
    spans = F.transform("proposed", lambda span: described(F.col("text"), span, params))
    return computed_once(proposed, "spans", spans).drop("proposed")


def labelled_phrases() -> list[tuple[str, int]]:
    """Phrases made from plain templates: 1 if what looks like personal data in them is."""
    phones = ("555-123-4567", "(020) 7946 0958", "555 867 5309", "030/901820-12", "0171 555 0199", "(555) 010-9988")
    mails = ("jane.roe (at) example (dot) org", "info [at] mail [dot] example [dot] com", "sales at shop dot example")
    addresses = ("10[.]20[.]30[.]40", "2001:0db8:0000:0000:0000:ff00:0042:8329", "2001:db8::ff00:42:8329", "fe80::1")
    longer = ("4111 1111 1111 1111 123", "4111 1111 1111 1111 12/26", "5500 0000 0000 0004 987", "2024 4111 1111 1111 1111")
    cards = ("3782 822463 10005", "371449635398431", "30569309025904", "4222222222222")
    good = [f"{lead} {p}{tail}" for lead in ("call", "my phone is", "tel:", "mobile", "fax") for p in phones for tail in ("", ".", " today")]
    good += [f"{lead} {m}{tail}" for lead in ("write to", "e-mail", "contact", "reach me:", "") for m in mails for tail in ("", " .", "!")]
    good += [f"{lead} {a}{tail}" for lead in ("host", "from ip", "server", "") for a in addresses for tail in ("", ",", " now")]
    good += [f"{lead} {c}{tail}" for lead in ("card", "amex", "credit card no.", "pay with") for c in (*cards, *longer) for tail in ("", ".", " please")]
    numbers = ("2024-01-15", "12/05/2019", "1234-5678", "100 200 300", "2019.12.24", "44 55 66 77", *phones)
    bad = [f"{lead} {n}{tail}" for lead in ("order", "ref", "version", "isbn", "serial no.", "date", "total of") for n in numbers for tail in ("", ".", " was")]
    bad += [f"{lead} {n}{tail}" for lead in ("about", "between", "in", "the") for n in numbers[:6] for tail in ("", ",")]
    bad += [f"{lead} {c}" for lead in ("order", "serial", "sku", "id", "the") for c in ("1234567890123", "987654321098765", *cards)]
    bad += [f"{lead} {c}" for lead in ("order", "the", "method", "use") for c in ("add::face", "dad::bed", "a::b")]
    bad += ["we met at noon dot and", "look at this dot dot"]
    return [(t, 1) for t in good] + [(t, 0) for t in bad]


def fit_judge(docs: DataFrame, params: PiiParams) -> tuple[boosting.Boosted, dict[int, float]]:
    """Trees and one threshold (log-odds) per kind.

    The documents give the count of every feature pattern of strict candidates, labelled by the strict check. Loose
    candidates of documents have no label; those of the phrases do.
    """
    names = [f"span.f_{n}" for n in FEATURES]
    spark = docs.sparkSession
    seen = with_candidates(docs.select("text"), params, (0,)).select(F.explode("spans").alias("span"))
    counted = seen.groupBy(*[F.col(n) for n in names]).agg(F.count(F.lit(1)).alias("times"))
    ranked = counted.orderBy(F.desc("times"), *[F.col(n.replace("span.", "")) for n in names]).limit(params.patterns)
    # stored first: collecting a sorted limit would send every partition's candidates to the driver
    top = Workspace.of(spark, "pii").save(ranked, "patterns")
    rows = [[*[r[f"f_{n}"] for n in FEATURES], r["f_checked"], float(np.log1p(r["times"]))] for r in top.collect()]
    phrases = spark.createDataFrame(labelled_phrases(), "text string, label int")
    told = with_candidates(phrases, params).select("label", F.explode("spans").alias("span")).where("span.f_loose = 1")
    # a phrase with a card has other candidates too, which overlap it and fail the check
    card = KINDS.index("card")
    for r in told.select("label", *names).collect():
        rows.append([*[r[f"f_{n}"] for n in FEATURES], r["label"] if r["f_kind"] != card or r["f_checked"] else 0, 1.0])
    data = np.array(rows, float).reshape(-1, len(FEATURES) + 2)
    bins, labels, weights = data[:, :-2].astype(np.int64), data[:, -2], data[:, -1]
    held = np.array([zlib.crc32(row.tobytes()) % 4 == 0 for row in bins], bool)
    trial = boosting.fit(bins[~held], labels[~held], weights[~held], params.trees, params.depth)
    limits = {}
    for kind in range(len(KINDS)):
        mine = held & (bins[:, 0] == kind) & (bins[:, 1] == 1)
        mine = mine if mine.any() else (bins[:, 0] == kind) & (bins[:, 1] == 1)
        scores = trial.log_odds(bins[mine])
        limits[kind] = max(0.0, boosting.threshold_for(scores, labels[mine], weights[mine], params.precision))
    return boosting.fit(bins, labels, weights, params.trees, params.depth), limits


def find_pii(docs: DataFrame, params: PiiParams = PiiParams()) -> DataFrame:
    """``(doc_id, text, spans array<struct<kind, start, end, base, score>>)``, one row per input row.

    Spans stand by kind as listed, then start. Strict matches that pass their check have ``base``. Of the loose candidates above their
    threshold those stay that touch no base span and no loose one with a better score. Null and empty
    texts have no spans; repeated rows are searched each for itself; other columns are not looked at.
    """
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    judge, limits = fit_judge(source, params)
    spans = with_candidates(source, params)
    score = judge.sql([f"s.f_{n}" for n in FEATURES])
    limit = " ".join(f"WHEN {k} THEN {v:.6f}D" for k, v in limits.items())
    judged = spans.withColumn("base", F.filter("spans", lambda s: (s["f_loose"] == 0) & s["strict_ok"])).withColumn(
        "scored",
        F.expr(
            "transform(filter(spans, s -> s.f_loose = 1), s -> named_struct('start', s.start, 'end', s.end, 'kind', s.f_kind,"
            f" 'score', {score}))"
        ),
    )
    judged = computed_once(judged, "good", F.expr(f"filter(scored, s -> s.score >= CASE s.kind {limit} END)"))
    touches = lambda x, y: (x["start"] < y["end"]) & (y["start"] < x["end"])
    beats = lambda x, y: (x["score"] > y["score"]) | (
        (x["score"] == y["score"]) & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & ((x["kind"] < y["kind"]) | ((x["kind"] == y["kind"]) & (x["end"] > y["end"])))))
    )
    chosen = F.filter(
        "good",
        lambda s: ~F.exists("base", lambda b: touches(b, s)) & ~F.exists("good", lambda g: touches(g, s) & beats(g, s)),
    )
    as_span = lambda kind, s, base, score: F.struct(
        kind.alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(base).alias("base"), score.alias("score")
    )
    both = F.concat(
        F.transform("base", lambda s: as_span(s["f_kind"], s, True, F.lit(None).cast("double"))),
        F.transform(chosen, lambda s: as_span(s["kind"], s, False, s["score"])),
    )
    named = F.transform(
        F.sort_array(both),
        lambda s: F.struct(
            F.element_at(F.lit(list(KINDS)), s["kind"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            s["base"].alias("base"), s["score"].alias("score"),
        ),
    )
    return judged.select("doc_id", "text", named.alias("spans"))
