"""Personal data in texts: patterns propose spans, checksums confirm, context scores.

Only Spark's own functions are used.  Spans count code points from 0, their end is
exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tables import unused

AROUND = 40  # code points before and after a span that are searched for context words


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes; ``hint`` is a plain test that every match's text passes.

    ``score`` holds for a confirmed span; a word of ``near`` shortly before or after it
    adds ``BONUS``, one of ``far`` takes ``MALUS``.
    """

    name: str
    pattern: str
    hint: str
    confirm: Callable[[Column], Column]
    score: float
    near: str
    far: str


BONUS, MALUS = 0.2, 0.3


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled; the digits then add up to tens."""
    n = F.length(digits)
    each = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.substring(digits, i, F.lit(1)).cast("int") * (1 + (n - i) % 2),
    )
    total = F.aggregate(each, F.lit(0), lambda s, d: s + d - F.when(d > 9, 9).otherwise(0))
    return (n > 0) & (total % 10 == 0)


def mod97(code: Column) -> Column:
    """The first four characters go last, letters count 10 to 35, and 1 remains modulo 97."""
    moved = F.concat(F.substring(code, 5, 99), F.substring(code, 1, 4))
    rest = F.aggregate(
        F.transform(
            F.sequence(F.lit(1), F.length(moved)), lambda i: F.ascii(F.substring(moved, i, F.lit(1)))
        ),
        F.lit(0),
        lambda s, c: F.when(c < 65, s * 10 + c - 48).otherwise(s * 100 + c - 55) % 97,
    )
    return rest == 1


def _email(hit: Column) -> Column:
    return F.lit(True)


def _ip(hit: Column) -> Column:
    return hit.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$")


def _card(hit: Column) -> Column:
    digits = _digits(hit)
    return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))


def _phone(hit: Column) -> Column:
    return F.length(_digits(hit)).between(8, 15)


# The length of an IBAN by its country.  Other countries are not judged by length.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
    "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26,
    "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15,
    "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
}


def _iban(hit: Column) -> Column:
    code = F.regexp_replace(hit, " ", "")
    lengths = F.create_map(*[F.lit(x) for item in IBAN_LENGTHS.items() for x in item])
    right = F.coalesce(lengths[F.substring(code, 1, 2)], F.length(code))
    return (F.length(code) == right) & mod97(code)


def _dni(hit: Column) -> Column:
    """The letter is the number modulo 23; X, Y, Z in front stand for 0, 1, 2."""
    number = F.translate(F.substring(hit, 1, 8), "XYZ", "012").cast("int")
    letters = F.lit("TRWAGMYFPDXBNJZSQVHLCKE")  # fixed values, by remainder
    return F.substring(letters, number % 23 + 1, F.lit(1)) == F.right(hit, F.lit(1))


def _ssn(hit: Column) -> Column:
    """Numbers that are never given out are none."""
    return ~hit.rlike("^(?:000|666|9)|-00-|-0000$")


def _secret(hit: Column) -> Column:
    """A key made by chance has digits; a private key's first line need not."""
    return hit.startswith("-----") | hit.rlike("[0-9]")


# The first four patterns are fixed values.  They are written so that long runs cost
# linear time and no stack: repeated groups are possessive (what follows cannot take
# back what they took), and a match starts where its run starts or the last one ended.
BASE = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        _email,
        0.8,
        "mail|contact|write|schreib|correo|courriel|kontakt",
        "noreply|example",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
        r"[0-9]\.[0-9]+\.[0-9]",
        _ip,
        0.5,
        "ip|address|host|server|login|adresse|direcci",
        "version|release|section|chapter|kapitel",
    ),
    Kind(
        "card",
        r"[0-9](?:[ -]?+[0-9])++",
        "[0-9][0-9 -]{15}",
        _card,
        0.7,
        "card|visa|credit|payment|karte|carte|tarjeta",
        "order|serial|isbn|tracking",
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        r"\+[0-9]",
        _phone,
        0.6,
        "phone|call|tel|mobile|fax|whatsapp|anruf|appel|llam",
        "score|points|vote",
    ),
)
ADDED = (
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)"
        r"(?![A-Za-z0-9])",
        "[A-Z][A-Z][0-9][0-9]",
        _iban,
        0.9,
        "iban|account|bank|konto|compte|cuenta",
        "example",
    ),
    Kind(
        "dni",
        r"(?<![A-Za-z0-9])[0-9XYZ][0-9]{7}-?[A-Z](?![A-Za-z0-9])",
        "[0-9]{7}-?[A-Z]",
        _dni,
        0.6,
        "dni|nie|nif|documento|identidad",
        "order|serial|tracking",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "[0-9]{3}-[0-9]{2}-[0-9]{4}",
        _ssn,
        0.4,
        "ssn|social security",
        "order|serial|tracking|part",
    ),
    # Public formats of access keys and tokens, and the first line of a private key.
    Kind(
        "secret",
        r"(?<![A-Za-z0-9_-])(?:A[KS]IA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}+"
        r"|eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)(?![A-Za-z0-9])"
        r"|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----",
        "A[KS]IA|gh[pousr]_|xox[abprs]-|eyJ|PRIVATE KEY-----",
        _secret,
        0.9,
        "key|token|secret|password|credential",
        "example",
    ),
)
KINDS = (*BASE, *ADDED)

_SPANS = "array<struct<start:int,end:int,hit:string,around:string>>"


def proposed(text: Column, kind: Kind) -> Column:
    """Leftmost non-overlapping matches with their places.

    The text between the matches and the matches themselves alternate; their lengths
    add up to the places.
    """
    gaps = F.split(text, kind.pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    # What stands after a hit is the gap that follows; the last gap has no hit.
    sides = F.zip_with(
        gaps,
        F.slice(gaps, F.lit(2), F.size(gaps)),
        lambda gap, after: F.struct(
            F.length(gap).alias("gap"),
            F.lower(
                F.concat_ws("\n", F.right(gap, F.lit(AROUND)), F.left(after, F.lit(AROUND)))
            ).alias("around"),
        ),
    )
    pairs = F.zip_with(
        sides,
        hits,
        lambda side, hit: F.struct(
            side["gap"].alias("gap"), F.length(hit).alias("n"), hit.alias("hit"), side["around"].alias("around")
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + pair["gap"]
        end = begin + F.coalesce(pair["n"], F.lit(0))
        span = F.struct(
            begin.alias("start"), end.alias("end"), pair["hit"].alias("hit"), pair["around"].alias("around")
        )
        spans = F.when(pair["hit"].isNull(), state["spans"]).otherwise(
            F.concat(state["spans"], F.array(span))
        )
        return F.struct(end.alias("at"), spans.alias("spans"))

    found = F.aggregate(pairs, start, step)["spans"]
    # Most texts fail the plain test and are not split at all.
    passes = text.contains(kind.hint) if kind.hint == "@" else text.rlike(kind.hint)
    return F.when(passes, found).otherwise(F.array().cast(_SPANS))


def confirmed(spans: Column, kind: Kind) -> Column:
    """The spans that pass the kind's check, scored by the words around them."""

    def scored(span: Column) -> Column:
        near = F.when(span["around"].rlike(kind.near), BONUS).otherwise(0.0)
        far = F.when(span["around"].rlike(kind.far), MALUS).otherwise(0.0)
        score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), kind.score + near - far))
        return F.struct(
            F.lit(kind.name).alias("kind"),
            span["start"].alias("start"),
            span["end"].alias("end"),
            F.round(score, 2).alias("score"),
        )

    return F.transform(F.filter(spans, lambda s: kind.confirm(s["hit"])), scored)


def with_spans(
    docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, *, name: str = "pii"
) -> DataFrame:
    """``docs`` with a column ``name``: array of struct ``kind``, ``start``, ``end``, ``score``.

    By kind as listed, then by place.  The text is searched once a kind.  A null text
    is an empty one.  A table that has the column already is refused.
    """
    if unused(docs, name) != [name]:
        raise ValueError(f"there is a column {name!r} already")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    held = unused(docs, *(k.name for k in kinds))
    raw = docs.withColumns({h: proposed(text, k) for h, k in zip(held, kinds, strict=True)})
    found = F.concat(*(confirmed(F.col(h), k) for h, k in zip(held, kinds, strict=True)))
    return raw.withColumn(name, found).drop(*held)


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _count(kind: str) -> Column:
    return F.size(F.filter("pii", lambda s: s["kind"] == kind))


def pii_summary(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` the personal data in its text.

    ``doc_id``; ``n_email``, ``n_ip``, ``n_card``, ``n_phone``; ``base_sha256`` of the
    spans of these kinds as ``kind:start:end``, by kind and then start, joined by
    commas; ``spans``: the same text for all kinds, the added ones (``ADDED``) last;
    ``scores`` in the order of ``spans``.

    A context word counts within ``AROUND`` code points before or after a span, up to the
    next span of its kind.  Texts are searched whole, in time that grows with their length.

    A null text is an empty one and has no spans; the hash is then that of an empty
    text.  A match that its check refuses is dropped, and its text is not searched
    again.  Rows are judged one by one: repeated rows get equal results, a null doc_id
    stays, an empty table gives none, and other columns are ignored.
    """
    only = docs.select("doc_id", "text")
    found = with_spans(only).select("doc_id", "pii")
    names = [k.name for k in BASE]
    base = F.filter("pii", lambda s: s["kind"].isin(names))
    return found.select(
        "doc_id",
        *(_count(n).cast("long").alias(f"n_{n}") for n in names),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )
