"""Scalar column expressions: all built in, no Python on the executors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK = "<anonymized>"
DEFAULT_SALT = "glasslake"
#: IBAN length by country.
IBAN_LENGTHS = {"DE": 22, "FR": 27, "NL": 18, "IE": 22, "DK": 18, "FI": 18, "SE": 24, "AT": 20, "BE": 16, "ES": 24, "IT": 27}
#: Patterns of values that are personal data as a whole, and where they are looked for in free text.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
IPV4 = r"\d{1,3}(?:\.\d{1,3}){3}"
PHONE = r"\+?\d[\d\s().-]{7,}"
IBAN = r"[A-Z]{2}\d{2}[A-Z0-9]{11,30}"
PERSON = r"[A-Z][a-z]+ [A-Z][a-z]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_pii(c: Column | str, salt: str = DEFAULT_SALT) -> Column:
    """sha256(salt:value) in lower hex; NULL stays NULL."""
    return F.sha2(F.concat(F.lit(f"{salt}:"), col(c)), 256)


def iban_compact(c: Column | str, lenient: bool = False) -> Column:
    return F.regexp_replace(F.upper(col(c)), r"[^A-Z0-9]" if lenient else r"[ \-]", "")


#: An IBAN as it is mostly written: signs of its country's number, digits alone behind the country.
PLAIN_IBAN = rf"\A(?:{'|'.join(f'{land}[0-9]{{{n - 2}}}' for land, n in IBAN_LENGTHS.items())})\z"


def _plain_mod97(c: Column | str) -> Column:
    """The rest of a plain IBAN modulo 97, by whole numbers: the digits up to the last twelve, these, country and check digits."""
    s = col(c)
    whole = lambda part: F.coalesce(part.try_cast("bigint"), F.lit(0).cast("bigint"))
    letter = lambda at: F.ascii(F.substring(s, at, 1)) - 55
    national = (whole(F.substr(s, F.lit(5), F.length(s) - 16)) % 97 * pow(10, 12, 97) + whole(F.substring(s, -12, 12))) % 97
    return (national * 1_000_000 + letter(1) * 10_000 + letter(2) * 100 + whole(F.substring(s, 3, 2))) % 97


def is_valid_iban(c: Column | str, lenient: bool = False) -> Column:
    """Length by country, digits in places 3 and 4, mod 97 = 1; NULL gives false.

    A plain one is decided by one pattern and whole numbers; only others are compacted and folded, which takes some ten times as long.
    """
    s = iban_compact(c, lenient)
    length = reduce(lambda acc, kv: acc.when(F.substring(s, 1, 2) == kv[0], kv[1]), list(IBAN_LENGTHS.items())[1:], F.when(F.substring(s, 1, 2) == "DE", IBAN_LENGTHS["DE"]))
    fold = F.aggregate(
        F.split(F.concat(F.substring(s, 5, 64), F.substring(s, 1, 4)), ""),
        F.lit(0),
        lambda acc, ch: F.when(ch.rlike("^[0-9]$"), (acc * 10 + ch.cast("int")) % 97).when(ch.rlike("^[A-Z]$"), (acc * 100 + (F.ascii(ch) - 55)) % 97).otherwise(acc),
    )
    shape = s.rlike(r"\A[A-Z]{2}[0-9]{2}[A-Z0-9]+\z") & (F.length(s) == length)
    return F.coalesce(F.when(col(c).rlike(PLAIN_IBAN), _plain_mod97(c) == 1).when(shape, fold == 1), F.lit(False))


def classify_value(c: Column | str) -> Column:
    """Sorted tags of a value that is personal data as a whole: EMAIL, IBAN, IP_ADDRESS, NAME, PHONE."""
    raw = col(c)
    v = F.trim(raw)
    octets = F.forall(F.split(v, r"\."), lambda o: (o.cast("int") <= 255) & ((F.length(o) == 1) | ~o.startswith("0")))
    email, iban = v.rlike(f"^{EMAIL}$"), is_valid_iban(raw, lenient=True)
    ip = v.rlike(f"^{IPV4}$") & F.coalesce(F.when(v.rlike(f"^{IPV4}$"), octets), F.lit(False))
    phone = v.rlike(f"^{PHONE}$") & raw.contains("+")
    name = v.rlike(f"^{PERSON}$") & (F.length(v) < 40) & ~(email | iban | ip | phone)
    tags = F.array(*[F.when(hit, F.lit(tag)) for hit, tag in ((email, "EMAIL"), (iban, "IBAN"), (ip, "IP_ADDRESS"), (name, "NAME"), (phone, "PHONE"))])
    return F.coalesce(F.array_sort(F.filter(tags, lambda t: t.isNotNull())), F.array().cast("array<string>"))


# The layouts of confirmation_hash, alert_id and chain_hash are fixed values: others recompute them.


def confirmation_hash(request: Column | str, customer: Column | str) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", col(request), col(customer)), 256), 1, 16)


def alert_key(rule: Column | str, customer: Column | str, event: Column | str, start: Column | str, end: Column | str) -> Column:
    """What an alert_id is the hash of: the parts joined by |, NULL as empty; window bounds are whole epoch seconds, so no time zone enters."""
    return F.concat_ws("|", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in (rule, customer, event, start, end)])


def alert_id(rule: Column | str, customer: Column | str, event: Column | str, start: Column | str, end: Column | str) -> Column:
    """sha256 of the alert's key."""
    return F.sha2(alert_key(rule, customer, event, start, end), 256)


def bucket_start(ts: Column | str, size: int) -> Column:
    return (F.floor(col(ts) / size) * size).cast("long")


def epoch_seconds(ts: Column | str) -> Column:
    """Epoch seconds with fractions of a timestamp column (without zone: UTC)."""
    return F.unix_micros(col(ts).cast("timestamp")) / 1e6


def live_pii(c: Column | str) -> Column:
    return F.coalesce((F.trim(col(c)) != "") & (col(c) != MASK), F.lit(False))


def differs(a: Column | str, b: Column | str) -> Column:
    return ~col(a).eqNullSafe(col(b))


def severity(rule: Column | str) -> Column:
    """Severity by rule."""
    return F.when(col(rule) == "VELOCITY", "HIGH").when(col(rule) == "AMOUNT_ZSCORE", "MEDIUM").otherwise("LOW")


def purge_status(status: Column | str, completed_at: Column | str) -> Column:
    """How a request's data stand: VERIFIED, PENDING, FAILED or UNKNOWN."""
    s = F.lower(col(status))
    return F.when((s == "completed") & col(completed_at).isNotNull(), "VERIFIED").when(s.isin("pending", "queued", "running"), "PENDING").when(s == "failed", "FAILED").otherwise("UNKNOWN")


def chain_hash(seq: Column | str, prev: Column | str, payload: Column | str) -> Column:
    return F.sha2(F.concat_ws("\n", col(seq).cast("string"), col(prev), col(payload)), 256)


def canonical_json(columns: list[str]) -> Column:
    """A compact JSON object with sorted keys; nulls are kept."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})


def masked(c: str, allowed: bool) -> Column:
    return F.col(c).cast("string") if allowed else F.lit("<masked>").alias(c)
