"""Personal data: regular expressions propose spans, checksums confirm them, words nearby adjust their score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonetide.llm.common import spare, texts

#: Fixed: the most digits of an address part, as text with any leading zeros.
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.

    `pattern` never matches the empty text and, started anywhere else inside a run it failed on, would fail again:
    possessive repeats and the look-behind only save the search from trying. `valid` is SQL over `x.v` (the match) and
    `x.d` (its digits). `certain` marks kinds whose valid matches always count; the others need the least score.
    With `head`, the pattern takes only so many characters and group 1 looks ahead at what may follow; `value` is then SQL
    over `w` (that group) for the text of the span, empty if there is none. So no match hides the start of another.
    """

    name: str
    pattern: str
    valid: str
    checked: bool
    context: str
    certain: bool = True
    start: float = 0.5
    needs: str = "[0-9]"
    head: int = 0
    value: str = "w"


#: Rearranged and with letters as two digits, the number leaves remainder 1; taken digit by digit, so it never grows.
_MOD97 = (
    "aggregate(split(concat(substr(replace({v}, ' ', ''), 5), substr(replace({v}, ' ', ''), 1, 4)), ''), 0, "
    "(a, c) -> if(c = '', a, if(c between '0' and '9', (a * 10 + ascii(c) - 48) % 97, (a * 100 + ascii(c) - 55) % 97)))"
)
#: Characters of an account number, and the countries that have so many.
_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_LENGTH = "map({})".format(", ".join(f"'{c}', {n}" for n, cs in _LENGTHS.items() for c in cs.split()))
#: Every end of the run that no letter or digit follows is tried: the end at the country's length counts if its check holds,
#: else the last whose check holds.
_IBAN = (
    "aggregate(filter(transform(sequence(15, char_length(w)), n -> if(substr(w, n + 1, 1) rlike '[A-Za-z0-9]', '', left(w, n))), "
    "y -> y rlike '^[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?$' "
    "and char_length(replace(y, ' ', '')) between 15 and 34 and " + _MOD97.replace("{v}", "y") + " = 1), '', "
    "(a, y) -> if(a != '' and char_length(replace(a, ' ', '')) = "
    "coalesce(try_element_at(" + _LENGTH + ", left(w, 2)), 0), a, y))"
)


# \G: right after the last match, where a run may go on that the look-behind would hide.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "true", False, "mail|contact|write|reply|address", needs="@",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        f"x.v rlike '^{_PART}(?:[.]{_PART}){{3}}$'", False, "ip|address|host|server|login",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9]){12,}+",
        "length(x.d) between 13 and 19 and luhn_check(x.d)", True, "card|visa|mastercard|amex|credit|payment",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "length(x.d) between 9 and 15", False, "phone|tel|call|mobile|fax", needs=r"\+[0-9]",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+[A-Za-z0-9]?))[A-Z]{2}[0-9]{2}",
        "x.v != ''", True, "iban|account|bank|konto|transfer",
        certain=False, needs="[A-Z]{2}[0-9]{2}", head=4, value=_IBAN,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        "true", False, "ssn|social security|tax id", certain=False, start=0.3, needs="[0-9]-[0-9]",
    ),
)
BASE = ("email", "ip", "card", "phone")

CHECKED, NEARBY, LEAST = 0.4, 0.3, 0.5
#: Characters before a span in which a context word counts.
REACH = 48

#: Matches before a span that may lie within REACH: none takes fewer than four characters.
_EARLIER = -(-REACH // 4)
#: Runs this long are added up first and then one after the other, so that no place's offset adds up all lengths before it.
_RUN = 64
#: Code points of the pieces that a text is cut into before its spans are replaced, first into long ones, then into short ones:
#: taking a part of a text counts its characters from its beginning on.
_LONG, _SHORT = 1 << 16, 1 << 10


def with_spans(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """The table with one array of (s, e, v, score) per kind, and the names of those columns.

    A match's place is the length of everything before it: the text split at the matches gives the gaps, and gaps and
    matches in turn add up to offsets in code points.
    """
    names = {k.name: spare(docs, f"spans_{k.name}") for k in KINDS}
    own = {k.name: [spare(docs, f"{p}_{k.name}") for p in ("match", "gap", "step", "run", "base", "begin", "end", "piece")] for k in KINDS}
    t = F.col(f"`{text}`")
    none = F.expr("cast(array() as array<string>)")
    out = docs.withColumns(
        {
            own[k.name][0]: F.when(t.rlike(k.needs), F.regexp_extract_all(t, F.lit(k.pattern), F.lit(1 if k.head else 0))).otherwise(none)
            for k in KINDS
        }
    )
    out = out.withColumns(
        {own[k.name][1]: F.when(F.size(own[k.name][0]) > 0, F.split(t, k.pattern, -1)).otherwise(none) for k in KINDS}
    )
    steps, runs, bases, begins, ends, pieces, spans = {}, {}, {}, {}, {}, {}, {}
    for k in KINDS:
        m, g, step, run, base, begin, end, piece = own[k.name]
        length = str(k.head) if k.head else f"char_length(`{m}`[greatest(i - 1, 0)])"
        steps[step] = F.expr(
            f"transform(`{m}`, (x, i) -> bigint(char_length(`{g}`[i]) + if(i = 0, 0, {length})))"
        )
        runs[run] = F.expr(
            f"if(size(`{m}`) = 0, cast(array() as array<bigint>), transform(sequence(0, (size(`{m}`) - 1) div {_RUN}), "
            f"b -> aggregate(slice(`{step}`, int(b * {_RUN} + 1), {_RUN}), 0L, (a, x) -> a + x)))"
        )
        bases[base] = F.expr(
            f"transform(`{run}`, (x, b) -> aggregate(slice(`{run}`, 1, b), 0L, (a, y) -> a + y))"
        )
        # A column that is named once only would be moved to where it is named, into the function, and made for every match:
        # its size is asked for besides.
        begins[begin] = F.expr(
            f"if(size(`{base}`) = 0, cast(array() as array<bigint>), transform(`{step}`, (x, i) -> `{base}`[int(i div {_RUN})] + "
            f"aggregate(slice(`{step}`, int(i div {_RUN}) * {_RUN} + 1, i % {_RUN} + 1), 0L, (a, y) -> a + y)))"
        )
        # What stands before a match: its gap's end and, where the gap is short, the matches and gaps before that.
        took = f"left(x, {k.head})" if k.head else f"right(x, {REACH})"
        ends[end] = F.expr(f"transform(`{g}`, x -> right(x, {REACH}))")
        pieces[piece] = F.expr(f"transform(`{m}`, (x, i) -> right(concat(`{end}`[i], {took}), {REACH}))")
        before = (
            f"if(i = 0 or char_length(`{end}`[i]) = {REACH}, `{end}`[i], right(concat(array_join(slice(`{piece}`, "
            f"greatest(i - {_EARLIER}, 0) + 1, least(i, {_EARLIER})), ''), `{end}`[i]), {REACH}))"
        )
        score = (
            f"round({k.start} + {CHECKED if k.checked else 0.0} + if(lower({before}) rlike "
            f"'(?<![a-z])(?:{k.context})', {NEARBY}, 0.0D), 2)"
        )
        nothing = "cast(array() as array<struct<s:bigint,e:bigint,v:string,d:string,score:double>>)"
        keep = k.valid if k.certain else f"({k.valid}) and x.score >= {LEAST}"
        spans[names[k.name]] = F.expr(
            f"if(size(`{piece}`) = 0, {nothing}, filter(transform(transform(`{m}`, w -> {k.value}), (v, i) -> struct(`{begin}`[i] as s, "
            f"`{begin}`[i] + char_length(v) as e, v, "
            f"regexp_replace(v, '[^0-9]', '') as d, least(1.0D, double({score})) as score)), x -> {keep}))"
        )
    for columns in (steps, runs, bases, begins, ends, pieces, spans):
        out = out.withColumns(columns)
    return out.drop(*[c for cs in own.values() for c in cs]), names


def _listed(names: dict[str, str], kinds, what: str) -> Column:
    parts = ", ".join(f"transform(`{names[k]}`, x -> {what.format(k=k)})" for k in kinds)
    return F.expr(f"array_join(concat({parts}), ',')")


def find_pii(docs: DataFrame) -> DataFrame:
    """Personal data in every whole text, one result row per row.

    Counts per kind, all spans as `kind:start:end` (code points, end exclusive; by kind, then start), the digest of the
    base kinds' spans, and the scores in the same order. Base kinds are all matches that pass their check. The other
    kinds, account numbers (mod 97 at some end of the run; two readings may overlap) and social security numbers, count at a score of 0.5: a passed checksum adds 0.4, a
    context word within 48 characters before the span 0.3.

    A null text counts as empty: counts 0 and an empty list. A null id stays null; repeated rows give repeated results;
    an empty table gives an empty one; other columns are not read.
    """
    found, names = with_spans(texts(docs))
    kinds = [k.name for k in KINDS]
    span = "concat('{k}:', x.s, ':', x.e)"
    return found.select(
        "doc_id",
        *[F.size(names[k]).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(_listed(names, BASE, span), 256).alias("base_sha256"),
        _listed(names, kinds, span).alias("spans"),
        *[F.size(names[k]).cast("long").alias(f"n_{k}") for k in kinds if k not in BASE],
        _listed(names, kinds, "string(x.score)").alias("scores"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """The table with every span replaced by its kind in angle brackets, and `n_chars`, where it exists, recounted.

    Spans of different kinds may overlap: they are taken by start, and what overlaps the last one joins it. A null text
    stays null. Columns, their order and all other values stay.
    """
    found, names = with_spans(docs)
    everything, cuts, parts, out = (spare(docs, n) for n in ("spans_all", "span_cuts", "text_parts", "redacted"))
    tagged = ", ".join(
        f"transform(`{names[k.name]}`, x -> struct(x.s as s, x.e as e, '<{k.name.upper()}>' as tag))" for k in KINDS
    )
    found = found.withColumn(everything, F.expr(f"array_sort(concat({tagged}))"))
    # Runs of spans at a time, so that what has been gathered is not copied for every span. A cut is the text between the end of the
    # last span and the start of this one, and its tag; a span that begins before that end has none.
    none = "cast(array() as array<struct<since:bigint,upto:bigint,tag:string>>)"
    kept = (
        "aggregate(slice(`{all}`, int(c * {run} + 1), {run}), struct(a.at as at, {none} as done), "
        "(b, x) -> struct(greatest(b.at, x.e) as at, "
        "if(x.s < b.at, b.done, array_append(b.done, struct(b.at as since, x.s as upto, x.tag as tag))) as done))"
    ).format(all=everything, run=_RUN, none=none)
    folded = (
        f"aggregate(sequence(0, (size(`{everything}`) - 1) div {_RUN}), struct(0L as at, cast(array() as "
        "array<array<struct<since:bigint,upto:bigint,tag:string>>>) as done), "
        f"(a, c) -> transform(array({kept}), r -> struct(r.at as at, array_append(a.done, r.done) as done))[0], "
        "a -> struct(a.at as at, flatten(a.done) as done))"
    )
    empty = f"struct(0L as at, {none} as done)"
    found = found.withColumn(cuts, F.expr(f"if(size(`{everything}`) > 0, {folded}, {empty})"))
    cut_up = "transform(sequence(0, greatest(char_length({x}) - 1, 0) div {n}), i -> substr({x}, int(i * {n} + 1), {n}))"
    long = cut_up.format(x="text", n=_LONG)
    short = f"flatten(transform({long}, w -> {cut_up.format(x='w', n=_SHORT).replace('i ->', 'j ->').replace('i *', 'j *')}))"
    found = found.withColumn(parts, F.expr(f"if(size(`{everything}`) > 0, {short}, cast(array() as array<string>))"))

    def between(since: str, upto: str) -> str:
        first = f"int({since} div {_SHORT})"
        count = f"int(({upto} - 1) div {_SHORT} - {since} div {_SHORT} + 1)"
        whole = f"array_join(slice(`{parts}`, {first} + 1, {count}), '')"
        return f"if({upto} <= {since}, '', substr({whole}, int({since} % {_SHORT} + 1), int({upto} - {since})))"

    done = F.expr(
        f"concat(array_join(transform(`{cuts}`.done, x -> concat({between('x.since', 'x.upto')}, x.tag)), ''), "
        f"{between(f'`{cuts}`.at', 'bigint(char_length(text))')})"
    )
    found = found.withColumn(out, F.when(F.size(everything) > 0, done).otherwise(F.col("text")))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col(out).alias(c))
        elif c == "n_chars":
            count = F.when(F.size(everything) > 0, F.char_length(out)).otherwise(F.col(c))
            columns.append(count.cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return found.select(*columns)
