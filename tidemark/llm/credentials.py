"""Secret scan with linking of multipart credentials.

Strong finds (assignments, access keys, long hexadecimal runs) stand for
themselves.  Weak candidates - long tokens of upper case and digits, all other
long tokens of mixed classes (UUIDs among them), and endpoints - are reported only where a part with another role starts within
``scope`` code points: an identifier needs a secret or an endpoint, and so on.
A weak candidate that overlaps a strong find starting within the scope is part
of it and not reported again, a token that overlaps an endpoint is part of that,
and what overlaps is no company.

The link is an interval join of a text's own parts.  They are sorted by start;
as finds of one pattern do not overlap, a known number of neighbours on either
side covers the interval, so the join takes linear time, needs no shuffle and
looks at no pair beyond the scope.

Only built-in expressions are used.  Null texts count as empty, and every row
gives a row, repeated ones each.  Places are code points, ends exclusive.  Very
long texts are scanned whole.  Columns of the input stay in ``doc``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import column, packed

SCOPE = 200
MARK = "[SECRET]"

# What the scan has to find.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# Weak candidates; the counted repeats keep matching linear.
TOKEN = r"[A-Za-z0-9+/_-]{16,}"
# Letters alone are taken for a secret from this length on.
_LETTERS = 20
IDENTIFIER = r"^[A-Z0-9]+$"
UUID = r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
ENDPOINT = r"""https?://[^\x20\x09-\x0D"'<>]+|[A-Za-z0-9-]{1,63}\.[A-Za-z0-9.-]{1,190}:[0-9]{2,5}"""

KINDS = ["assign", "access", "hex", "weak_id", "weak_secret", "endpoint"]
_ROLE = {"assign": 1, "access": 0, "hex": 1, "weak_id": 0, "weak_secret": 1, "endpoint": 2}
_N_STRONG = 3
# The shortest find of each pattern, in code points.
_SHORTEST = [12, 20, 24, 16, 5]
_GROUP = 64
# The same matches, found faster: what cannot start one is left at its first
# character, a run is entered at its beginning only, and nothing is given back
# that could not be followed by what comes next.
_FAST = {
    ASSIGN: ASSIGN.replace("(?i)", "(?i)(?=[apst])", 1),
    ACCESS: ACCESS,
    HEX: f"(?<![0-9a-f]){HEX}+",
    TOKEN: f"(?<![A-Za-z0-9+/_-]){TOKEN}+",
    ENDPOINT: ENDPOINT.replace("{1,63}", "{1,63}+").replace("{1,190}", "{1,190}+"),
}


def _all_of(text: Column, pattern: str, possible: Column) -> Column:
    """The finds of a pattern; a text where none is ``possible`` is not searched."""
    found = F.regexp_extract_all(text, F.lit(_FAST[pattern]), F.lit(0))
    return F.when(possible, found).otherwise(F.array().cast("array<string>"))


def _let(value: Column, use) -> Column:
    """``use(value)``, the value worked out once, also where a function uses it for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _places(text: Column, pattern: str, found: Column) -> Column:
    """Starts of the finds: lengths of the gaps and finds before them, summed.

    The text is split once and each sum made once, however many finds there are.
    """
    lengths = F.transform(F.split(text, _FAST[pattern], -1), F.length)
    steps = lambda gaps: F.zip_with(
        gaps, found, lambda g, m: g + F.coalesce(F.length(m), F.lit(0))
    )
    # Sums of groups of steps first, so that a text of many finds stays cheap.
    groups = lambda steps: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _GROUP).cast("int")),
        lambda k: F.aggregate(F.slice(steps, k * _GROUP + 1, _GROUP), F.lit(0), lambda a, x: a + x),
    )
    before = lambda steps: F.aggregate(
        groups(steps),
        F.array(F.lit(0)),
        lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)),
    )
    starts = lambda gaps, steps, before: F.transform(
        found,
        lambda m, i: F.get(before, F.floor(i / _GROUP).cast("int"))
        + F.aggregate(
            F.slice(steps, F.floor(i / _GROUP).cast("int") * _GROUP + 1, i % _GROUP),
            F.lit(0),
            lambda a, x: a + x,
        )
        + F.get(gaps, i),
    )
    return _let(
        lengths,
        lambda gaps: _let(
            steps(gaps), lambda made: _let(before(made), lambda sums: starts(gaps, made, sums))
        ),
    )


_PART = "array<struct<start:int,kind:int,end:int>>"


def _parts(text: Column, pattern: str, found: Column, kind) -> Column:
    """Finds as parts; ``kind(find, i)`` gives the kind's number, or null to drop it."""
    made = F.zip_with(
        F.transform(found, lambda m, i: F.struct(m.alias("m"), kind(m, i).alias("kind"))),
        _places(text, pattern, found),
        lambda f, at: F.struct(
            at.alias("start"), f["kind"].alias("kind"), (at + F.length(f["m"])).alias("end")
        ),
    )
    some = F.filter(made, lambda p: p["kind"].isNotNull()).cast(_PART)
    return F.when(F.size(found) > 0, some).otherwise(F.array().cast(_PART))


def _token_kind(token: Column, _) -> Column:
    """Upper case with digits may be an identifier, any other mix of classes a secret; the link decides."""
    has = lambda p: token.rlike(p)
    long = F.length(token) >= _LETTERS
    return F.when(has(IDENTIFIER) & has("[0-9]") & has("[A-Z]"), F.lit(3)).when(
        (has("[a-z]") & (has("[0-9]") | (has("[A-Z]") & long))) | has(UUID), F.lit(4)
    )


def find_secrets(
    docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, scope: int = SCOPE
) -> DataFrame:
    """``doc`` (a struct of ``keep``), ``text`` and ``parts``: start, kind's number and end.

    Parts are sorted by start, then kind.
    """
    frame = docs.select(packed(docs, keep), F.coalesce(column(text), F.lit("")).alias("text"))
    has = lambda mark: F.contains("text", F.lit(mark))
    frame = frame.select("doc", "text", _all_of(F.col("text"), TOKEN, F.lit(True)).alias("token"))
    # Access keys and long hexadecimal runs lie within tokens.
    some = F.size("token") > 0
    possible = {ASSIGN: has(":") | has("="), ACCESS: some, HEX: some, ENDPOINT: has(":")}
    all_of = lambda p: _all_of(F.col("text"), p, possible[p])
    frame = frame.select(
        "doc",
        "text",
        all_of(ASSIGN).alias("assign"),
        all_of(ACCESS).alias("access"),
        all_of(HEX).alias("hex"),
        "token",
        all_of(ENDPOINT).alias("endpoint"),
    )
    part = lambda p, name, kind: _parts(F.col("text"), p, F.col(name), kind)
    value = lambda m: F.regexp_extract(m, ASSIGN, 2)
    strong = F.concat(
        part(ASSIGN, "assign", lambda m, i: F.when(F.length(value(m)) >= 6, F.lit(0))),
        part(ACCESS, "access", lambda m, i: F.lit(1)),
        part(HEX, "hex", lambda m, i: F.lit(2)),
    )
    weak = F.concat(
        part(TOKEN, "token", _token_kind), part(ENDPOINT, "endpoint", lambda m, i: F.lit(5))
    )
    frame = frame.select("doc", "text", strong.alias("strong"), weak.alias("weak"))
    frame = frame.select(
        "doc",
        "text",
        F.sort_array(F.concat("strong", "weak")).alias("parts"),
        (F.size("weak") > 0).alias("any_weak"),
    )
    return frame.select(
        "doc",
        "text",
        F.when(F.col("any_weak"), _linked(F.col("parts"), scope)).otherwise(F.col("parts")).alias("parts"),
    )


def _linked(parts: Column, scope: int) -> Column:
    """Strong parts, and weak ones that lie beside no strong one but near another role."""
    reach = sum(scope // n + 1 for n in _SHORTEST)
    roles = F.array(*(F.lit(_ROLE[k]) for k in KINDS))
    role = lambda p: F.get(roles, p["kind"])
    near = lambda i: F.sequence(
        F.greatest(F.lit(0), i - reach), F.least(F.size(parts) - 1, i + reach)
    )

    def stays(p: Column, i: Column) -> Column:
        other = lambda j: F.get(parts, j)
        close = lambda q: F.abs(q["start"] - p["start"]) <= scope
        overlaps = lambda q: (q["start"] < p["end"]) & (p["start"] < q["end"])
        around = lambda q: (q["kind"] < _N_STRONG) | ((q["kind"] == 5) & (p["kind"] < 5))
        inside = F.exists(near(i), lambda j: around(other(j)) & close(other(j)) & overlaps(other(j)))
        complement = F.exists(
            near(i),
            lambda j: (role(other(j)) != role(p)) & close(other(j)) & ~overlaps(other(j)),
        )
        return (p["kind"] < _N_STRONG) | (~inside & complement)

    return F.filter(parts, stays)


def _written(parts: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(parts, lambda p: F.concat_ws(":", F.get(names, p["kind"]), p["start"], p["end"])),
        ",",
    )


def secret_report(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """Counts of strong finds, their digest, and all spans, one row per document."""
    found = find_secrets(docs, keep=[doc_id], **options).drop("text")
    strong = F.filter("parts", lambda p: p["kind"] < _N_STRONG)
    count = lambda k: F.size(F.filter("parts", lambda p: p["kind"] == k)).cast("bigint")
    return found.select(
        F.col(f"doc.`{doc_id}`").alias("doc_id"),
        *(count(k).alias(f"n_{KINDS[k]}") for k in range(_N_STRONG)),
        F.sha2(_written(strong).cast("binary"), 256).alias("base_sha256"),
        _written(F.col("parts")).alias("spans"),
    )


def redact_secrets(
    docs: DataFrame, *, text: str = "text", n_chars: str | None = "n_chars", mark: str = MARK, **options
) -> DataFrame:
    """``docs`` with every find replaced by ``mark``, columns as given.

    Finds that overlap become one mark.  ``n_chars``, if the column is there,
    follows the new text.
    """
    found = find_secrets(docs, text=text, **options)
    cut = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda a, p: F.struct(
            F.greatest(a["at"], p["end"]).alias("at"),
            F.when(
                p["start"] >= a["at"],
                F.concat(
                    a["out"],
                    F.array(F.substring("text", a["at"] + 1, p["start"] - a["at"]), F.lit(mark)),
                ),
            ).otherwise(a["out"]).alias("out"),
        ),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring("text", a["at"] + 1, F.length("text"))),
    )
    original = F.col(f"doc.`{text}`")
    found = found.select(
        "doc",
        (F.size("parts") > 0).alias("found"),
        F.when(F.size("parts") > 0, cut).otherwise(original).alias("clean"),
    )
    new = {text: F.col("clean")}
    if n_chars in docs.columns:
        kind = docs.schema[n_chars].dataType
        new[n_chars] = F.when(F.col("found"), F.length("clean").cast(kind)).otherwise(
            F.col(f"doc.`{n_chars}`")
        )
    return found.select(
        *(new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns)
    )
