"""PII replacement by surrogates.

Entities are found by pattern: e-mail and IP addresses, phone numbers, card numbers and IBANs, and the given and family
names of persons. A person is a capitalised name with evidence beside it: a title, a usual given name before a family
name, a verb of speech, the head of a letter, a closing line, or words that introduce. A name that has evidence somewhere
is also replaced where it stands alone in its text. Each distinct entity gets one surrogate drawn from a keyed hash: of the same type, script and format, given names of the same gender,
cards and IBANs with check digits that fit. All mentions of an entity get its surrogate, written in the mention's own
format; as given and family names are entities of their own, "Mr. John Smith" and "Mr. Smith" stay one person.

Collisions are checked over all entities: two entities never share a surrogate and no surrogate is itself an entity of
the corpus; whoever loses draws again. Every WIDEN draws the format grows by one digit, letter or name part, so a
format that the corpus has used up does not stop the job. Initials are shifted along their alphabet instead: there
are too few of them to avoid each other.

Limits: persons without any such evidence in their text, and phone numbers without a prefix or area code, stay.

Defined results: null and empty texts have no entities; offsets are code points, end exclusive; null ids are kept as
null; repeated rows give equal rows; an empty table gives no rows; other columns are ignored (scan) or kept (replace).
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasslake.llm.common import materialize, slices, texts

KINDS = ("email", "iban", "ip", "ip6", "phone", "card", "given", "family")
#: Draws of one format before it grows.
WIDEN = 8
_EMAIL = re.compile(r"(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)+")
_IP = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)")
_IP6 = re.compile(r"(?<![\w:.])(?=[0-9a-fA-F:]*:[0-9a-fA-F:]*:)[0-9a-fA-F:]{4,39}(?![\w:])")
_PHONE = re.compile(r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){1,4}(?!\w)")
#: National numbers: an area code in brackets or with a leading zero, or three groups of 3, 3 and 4 digits.
_NATIONAL = re.compile(r"(?<![\w+.-])(?:\(\d{2,5}\)[ -]?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|0\d{1,4}[ /.-]\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?![\w]|[.-]\d)")
NATIONAL_DIGITS = (9, 13)
_CARD = re.compile(r"(?<![\w.+-])(?:\d{4}[ -]){3}\d{4}(?!\w)|(?<![\w.+-])\d{13,19}(?!\w)")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?!\w)")
#: Titles with the gender they tell (f, m, n for neither).
TITLES = {"Mr.": "m", "Mr": "m", "Mrs.": "f", "Mrs": "f", "Ms.": "f", "Ms": "f", "Miss": "f", "Dr.": "n", "Prof.": "n", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Señor": "m", "Señora": "f", "Sr.": "m", "Sra.": "f", "г-н": "m", "г-жа": "f"}
_NAME = r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))*"
_PERSON = re.compile(r"(?<!\w)(" + "|".join(re.escape(t) for t in sorted(TITLES, key=len, reverse=True)) + rf")\s({_NAME})(?: ({_NAME}))?")
#: Given names by script and gender.
GIVEN = {
    ("latin", "f"): ["Anna", "Clara", "Diana", "Elena", "Flora", "Helena", "Irene", "Julia", "Laura", "Maria", "Nora", "Paula", "Rosa", "Sara", "Teresa", "Vera"],
    ("latin", "m"): ["Adrian", "Bruno", "Carlos", "Daniel", "Erik", "Felix", "Hugo", "Ivan", "Jonas", "Karl", "Leo", "Martin", "Oscar", "Paul", "Simon", "Viktor"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"],
    ("cyrillic", "m"): ["Андрей", "Борис", "Иван", "Кирилл", "Лев", "Максим", "Павел", "Юрий"],
    ("greek", "f"): ["Άννα", "Ελένη", "Ειρήνη", "Μαρία", "Σοφία", "Χριστίνα"],
    ("greek", "m"): ["Αλέξης", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"],
}
#: Beginnings and endings of family names by script.
FAMILY = {
    "latin": ("Al Bar Ber Cal Dal Ehr Fal Gar Hal Hart Kel Lang Lind Mar Mont Nord Ost Pal Ros Sal Stein Tor Val Wal West Win".split(), "berg dorf er feld ford holm land lin man mar mond o ow sen son stedt ton vale wald well".split()),
    "cyrillic": ("Бел Вол Гор Дар Зор Кол Лен Мор Нов Пет Род Сав Тар Хол Шар".split(), "анко ев енко ин ич ко ов овский ский ук".split()),
    "greek": ("Αλεξ Βασ Γεωργ Δημ Ζαχ Θεοδ Καρ Λαμπ Μιχ Νικ Παπ Σταυρ".split(), "άκης άκος άτος έλης ίδης όπουλος ούλης ώτης".split()),
}
#: Usual given names that are evidence of a person where a family name follows; none is a common word, a month or a town.
FORENAMES = {
    "f": """Alice Amelia Andrea Angela Anne Barbara Beatrice Brigitte Camille Caroline Catherine Charlotte Christine Claire Claudia
        Elizabeth Emily Emma Eva Françoise Hannah Isabel Jane Jennifer Jessica Johanna Karen Katharina Linda Lisa Lucy Margaret Marie
        Martina Mary Michelle Monika Nancy Nicole Olivia Patricia Rachel Rebecca Ruth Sabine Sandra Sarah Silvia Sofia Sophie Susan Ursula""".split(),
    "m": """Albert Alexander Andreas Andrew Anthony Antonio Benjamin Charles Christian Christopher David Diego Edward Fernando
        Francisco François George Hans Harold Henry Jacques James Javier Jean Jeffrey John José Joseph Juan Jürgen Kenneth Klaus Lars Luis
        Lukas Manuel Matthew Michael Miguel Nicolas Pablo Patrick Pedro Peter Philip Pierre Rafael Richard Robert Samuel Stefan Stephen
        Thomas Timothy Tobias Walter William Wolfgang""".split(),
}
#: Verbs of speech, heads of letters, closing lines and introductions, by language.
SPEECH = """said says told asked replied wrote writes added explained announced sagte sagt schrieb erklärte fragte antwortete dit déclare
    déclara écrit répond demanda dijo dice escribió explicó respondió preguntó сказал сказала написал написала ответил ответила είπε έγραψε απάντησε""".split()
HEADS = "From To Cc Bcc Reply-To Sender Author Von An De Para À От Кому Από Προς".split()
CLOSINGS = [
    "best regards", "kind regards", "warm regards", "regards", "best wishes", "sincerely", "yours sincerely", "yours truly", "yours faithfully", "cheers", "many thanks",
    "mit freundlichen grüßen", "viele grüße", "beste grüße", "liebe grüße", "cordialement", "bien à vous", "amicalement", "saludos", "un saludo", "atentamente",
    "с уважением", "με εκτίμηση",
]
INTRODUCTIONS = [
    "my name is", "i am called", "ich heiße", "mein name ist", "je m'appelle", "mon nom est", "me llamo", "mi nombre es", "меня зовут", "με λένε", "ονομάζομαι",
]
#: Capitalised words that are no given name, that only announce a family name, and that are no family name.
NO_GIVEN = set("""The A An This That These Those He She It They We You I And But So As In On At For If When While However Then Also Our His Her Their My
    New Old North South East West San Saint Los Las United Der Die Das Ein Eine Er Sie Es Wir Ihr Und Aber Doch In Am Im Le La Les Un Une Il Elle Nous Vous Et
    Mais El Los Una Ella Y Pero Он Она Они Мы И Но""".split())  # fmt: skip
ROLES = set("""President Minister Chancellor Director Senator Judge Professor Doctor Captain Bundeskanzler Präsident Professorin Ministerin Président
    Ministre Presidente Ministro Directora""".split())  # fmt: skip
NO_FAMILY = set("""Inc Ltd LLC Corp Company GmbH AG Bank University College School Institute Hospital Station Street Road Avenue Square City County Park
    River Lake Island Islands Church Museum Bridge Airport Prize Award Day Act Department Ministry Committee Team News Times""".split())  # fmt: skip
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
_GENDER = {name.lower(): gender for gender, names in [*((g, n) for (_, g), n in GIVEN.items()), *FORENAMES.items()] for name in names}

_WORD = r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))*+"
_INITIALS = r"(?:(?:[^\W\d_]\.)+[ \t]+)?"
_FULL = rf"({_WORD})[ \t]+{_INITIALS}({_WORD})"
_SOME = rf"({_WORD})(?:[ \t]+{_INITIALS}({_WORD}))?"


def _any(words) -> str:
    return "(?:" + "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True)) + ")"


_SPOKEN = re.compile(rf"(?<!\w){_any(SPEECH)}(?!\w)")
_SPEAKER = re.compile(rf"(?<!\w){_FULL},?[ \t]+{_any(SPEECH)}(?!\w)")
_SPEAKER_BEHIND = re.compile(rf"(?<!\w){_any(SPEECH)}[ \t]+{_FULL}")
_HEAD = re.compile(rf"(?m)^[ \t>]*{_any(HEADS)}[ \t]*:[ \t]*\"?{_SOME}\"?[ \t]*(<|\(|,|;|\r?$)")
_CLOSING = re.compile(rf"(?mi)^[ \t>]*{_any(CLOSINGS)}[ \t]*[,.!]?[ \t]*\r?\n[ \t\r\n]*+{_SOME}[ \t]*\r?$")
_INTRODUCED = re.compile(rf"(?i)(?<!\w){_any(INTRODUCTIONS)}[ \t]+{_SOME}")
_FORENAME = re.compile(rf"(?<!\w)({_any(n for names in [*GIVEN.values(), *FORENAMES.values()] for n in names)})[ \t]+{_INITIALS}({_WORD})")
_LETTERS = re.compile(r"(?<!\w)[^\W\d_]+")
_GOES_ON = re.compile(r"[\w-]")


def script(text: str) -> str:
    """latin, cyrillic or greek, else other; by the first letter."""
    for c in text:
        if "Ѐ" <= c <= "ӿ":
            return "cyrillic"
        if "Ͱ" <= c <= "Ͽ":
            return "greek"
        if c.isalpha():
            return "latin" if c < "ɐ" else "other"
    return "latin"


def alphabet(letter: str) -> str:
    """Letters of the same script; of scripts without an alphabet here the neighbours in the code table."""
    name = script(letter)
    if name != "other":
        return ALPHABETS[name]
    block = ord(letter) & ~0x3F
    return "".join(chr(c) for c in range(block, block + 64) if chr(c).isalpha() and chr(c) == chr(c).lower()) or letter


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _numbers(text: str) -> Iterator[tuple[str, int, int, str, str]]:
    for m in _IP.finditer(text):
        yield "ip", m.start(), m.end(), m[0], ""
    for m in _PHONE.finditer(text):
        yield "phone", m.start(), m.end(), "+" + _digits(m[0]), ""
    for m in _NATIONAL.finditer(text):
        if NATIONAL_DIGITS[0] <= len(_digits(m[0])) <= NATIONAL_DIGITS[1]:
            yield "phone", m.start(), m.end(), _digits(m[0]), ""
    for m in _CARD.finditer(text):
        yield "card", m.start(), m.end(), _digits(m[0]), ""
    for m in _IBAN.finditer(text):
        plain = m[0].replace(" ", "")
        if 15 <= len(plain) <= 34 and mod97(plain) == 1:
            yield "iban", m.start(), m.end(), plain, ""
    if text.count(":") >= 2:
        for m in _IP6.finditer(text):
            try:
                yield "ip6", m.start(), m.end(), ipaddress.IPv6Address(m[0]).exploded, ""
            except ValueError:
                continue


def _untitled(text: str) -> Iterator[tuple[re.Match, bool]]:
    """Matches of a given name (group 1) and perhaps a family name (group 2) with evidence but no title; whether a given name alone counts."""
    if _SPOKEN.search(text):
        yield from ((m, False) for m in _SPEAKER.finditer(text))
        yield from ((m, False) for m in _SPEAKER_BEHIND.finditer(text))
    if ":" in text:
        yield from ((m, m[3] == "<" or m[1].lower() in _GENDER) for m in _HEAD.finditer(text))
    yield from ((m, True) for m in _CLOSING.finditer(text))
    yield from ((m, True) for m in _INTRODUCED.finditer(text))
    yield from ((m, False) for m in _FORENAME.finditer(text))


def _evident(text: str) -> Iterator[tuple[str, int, int, str]]:
    """(kind, start, end, gender) of names of persons who have evidence but no title there."""
    for m, alone in _untitled(text):
        given, family = m[1][0].isupper() and m[1] not in NO_GIVEN, m[2] is not None and m[2][0].isupper() and m[2] not in NO_FAMILY
        if not given or m[1] in TITLES or (m[2] is not None and m[2] in NO_FAMILY) or not (family or alone):
            continue
        if m[1] not in ROLES:
            yield "given", m.start(1), m.end(1), _GENDER.get(m[1].lower(), "n")
        if family:
            yield "family", m.start(2), m.end(2), ""


def _titled(text: str) -> Iterator[tuple[str, int, int, str]]:
    """(kind, start, end, gender) of names behind titles."""
    for m in _PERSON.finditer(text):
        if not m[2][0].isupper() and script(m[2]) != "other":
            continue
        gender = TITLES[m[1]]
        parts = [2, 3] if m[3] and (m[3][0].isupper() or script(m[3]) == "other") else [2]
        for k in parts:
            kind = "given" if len(parts) == 2 and k == 2 else "family"
            if kind == "given" and gender == "n":
                gender = _GENDER.get(m[k].lower(), "n")
            yield kind, m.start(k), m.end(k), gender if kind == "given" else ""


def _persons(text: str) -> Iterator[tuple[str, int, int, str, str]]:
    """Names with evidence, those with titles first, then the same words where they stand alone.

    A word is one kind of name in all of its text: the one it has where it is met first.
    """
    known: dict[str, tuple[str, str]] = {}
    for kind, start, end, gender in itertools.chain(_titled(text), _evident(text)):
        name = text[start:end]
        if len(name) >= 3:
            kind, gender = known.setdefault(name, (kind, gender))
        yield kind, start, end, name.lower(), gender
    if known:
        # by the first run of letters, so that the work does not grow with the number of names
        starting: dict[str, list[str]] = {}
        for name in sorted(known, key=len, reverse=True):
            starting.setdefault(_LETTERS.match(name)[0], []).append(name)
        at = 0
        for m in _LETTERS.finditer(text):
            for name in starting.get(m[0], ()) if m.start() >= at else ():
                end = m.start() + len(name)
                if text.startswith(name, m.start()) and not _GOES_ON.match(text, end):
                    yield known[name][0], m.start(), end, name.lower(), known[name][1]
                    at = end
                    break


def mentions(text: str) -> list[tuple[str, int, int, str, str]]:
    """(kind, start, end, entity, gender) of each mention, none overlapping; entity is the same for all its formats."""
    found: list[tuple[str, int, int, str, str]] = []
    if "@" in text:
        found += [("email", m.start(), m.end(), m[0].lower(), "") for m in _EMAIL.finditer(text)]
    if any(c in text for c in "0123456789"):
        found += _numbers(text)
    elif "::" in text:
        found += (x for x in _numbers(text) if x[0] == "ip6")
    found += _persons(text)
    out, end = [], 0
    for x in sorted(found, key=lambda x: (x[1], -x[2], KINDS.index(x[0]))):
        if x[1] >= end:
            out.append(x)
            end = x[2]
    return out


class _Draws:
    """A stream of numbers from a keyed hash of the entity and the attempt."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int) -> None:
        self.seed, self.block, self.left = (key, f"{kind}\0{entity}\0{attempt}".encode("utf-8", "surrogatepass")), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hmac.new(self.seed[0], self.seed[1] + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block += 1
        x, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return x % n

    def pick(self, of):
        return of[self.below(len(of))]

    def digits(self, n: int) -> str:
        return "".join(str(self.below(10)) for _ in range(n))


def _letters(word: str, draws: _Draws) -> str:
    """Letters to letters of the same script and case, digits to digits, other signs as they are."""
    out = []
    for c in word:
        if c.isdigit():
            out.append(draws.digits(1))
        elif c.isalpha():
            d = draws.pick(alphabet(c))
            out.append(d.upper() if c.isupper() else d)
        else:
            out.append(c)
    return "".join(out)


def _card(digits: str, fits: bool, draws: _Draws) -> str:
    last = next(d for d in range(10) if luhn(digits + str(d)))
    return digits + str(last if fits else (last + 1 + draws.below(9)) % 10)


def surrogate(kind: str, entity: str, gender: str, attempt: int, key: bytes) -> str:
    """The surrogate entity, in the plain form that mentions() gives; each WIDEN attempts it is one part longer."""
    draws, more = _Draws(key, kind, entity, attempt), attempt // WIDEN
    if kind == "email":
        name, _, domain = entity.partition("@")
        head, _, top = domain.rpartition(".")
        return f"{_letters(name + 'a' * more, draws)}@{_letters(head, draws)}.{top}"
    if kind == "ip":
        return ".".join(str(1 + draws.below(254)) for _ in range(4))
    if kind == "ip6":
        return ":".join("".join(draws.pick("0123456789abcdef") for _ in range(4)) if g != "0000" or more else g for g in entity.split(":"))
    if kind == "phone":
        lead = 2 if entity[0] == "+" else 1
        return entity[:lead] + draws.digits(len(entity) - lead + more)
    if kind == "card":
        return _card(entity[:1] + draws.digits(len(entity) - 2 + more), luhn(entity), draws)
    if kind == "iban":
        body = "".join(draws.digits(1) if c.isdigit() else draws.pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for c in entity[4:]) + draws.digits(more)
        return f"{entity[:2]}{98 - mod97(entity[:2] + '00' + body):02d}{body}"
    if len(entity) == 1:  # an initial: one shift for all, so initials stay different
        letters = alphabet(entity)
        return letters[(letters.index(entity) + 1 + _Draws(key, "initial", letters, 0).below(max(len(letters) - 1, 1))) % len(letters)] if entity in letters else _letters(entity, draws)
    name = script(entity)
    if name == "other":
        return _letters(entity, draws) + "".join(draws.pick(alphabet(entity[0])) for _ in range(more))
    if kind == "given":
        pool = GIVEN[name, gender if gender in ("f", "m") else draws.pick("fm")]
        return "-".join(draws.pick(pool) for _ in range(1 + more)).lower()
    return "-".join(draws.pick(FAMILY[name][0]) + draws.pick(FAMILY[name][1]) for _ in range(1 + more)).lower()


def render(surface: str, kind: str, entity: str) -> str:
    """The surrogate in the format of a mention: its separators, its capitals."""
    if kind in ("phone", "card"):
        digits = iter(entity.lstrip("+"))
        return "".join(next(digits, "0") if c.isdigit() else c for c in surface) + "".join(digits)
    if kind == "iban":
        signs = iter(entity)
        return "".join(c if c == " " else next(signs, "") for c in surface) + "".join(signs)
    if kind == "ip6":
        out = entity if len(surface) == 39 else ipaddress.IPv6Address(entity).compressed
        return out.upper() if surface.isupper() else out
    if kind == "email":
        if surface.isupper():
            return entity.upper()
        return "".join(e.upper() if s.isupper() else e for s, e in itertools.zip_longest(surface[: len(entity)], entity, fillvalue=""))
    if kind in ("given", "family"):
        if surface.isupper():
            return entity.upper()
        return "-".join(p[:1].upper() + p[1:] for p in entity.split("-")) if surface[:1].isupper() else entity
    return entity


def find_mentions(docs: DataFrame) -> DataFrame:
    """doc_id, kind, start, end, surface, entity, gender of every mention in documents(doc_id, text)."""
    schema = "doc_id long, kind string, start int, end int, surface string, entity string, gender string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in schema.split(", ")]
        types = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()]
        for part in (p for batch in batches for p in slices(batch, "text")):
            rows = [(d, k, a, b, t[a:b], e, g) for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) for k, a, b, e, g in mentions(t)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return texts(docs).mapInArrow(run, schema)


def assign_surrogates(found: DataFrame, key: str) -> DataFrame:
    """kind, entity, replacement: one distinct surrogate per entity (initials excepted, see above)."""
    import pandas as pd

    def draw(kind, entity, gender, attempt):
        return pd.Series([surrogate(k, e, g, a, key.encode()) for k, e, g, a in zip(kind, entity, gender, attempt, strict=True)], dtype=object)

    draw.__annotations__ = {"kind": pd.Series, "entity": pd.Series, "gender": pd.Series, "attempt": pd.Series, "return": pd.Series}
    drawn = F.pandas_udf(draw, "string")
    # a name met with and without a telling title is one entity: the telling title counts (f and m come before n)
    entities = found.groupBy("kind", "entity").agg(F.min("gender").alias("gender"))
    state = materialize(entities.withColumn("attempt", F.lit(0)).withColumn("replacement", drawn("kind", "entity", "gender", "attempt")), "surrogates")
    while True:
        free = state.where(F.length("entity") > 1)
        first = free.groupBy("kind", "replacement").agg(F.min(F.struct("attempt", "entity")).alias("first"), F.count("*").alias("n"))
        shared = free.join(first.where("n > 1"), ["kind", "replacement"]).where(F.struct("attempt", "entity") != F.col("first")).select("kind", "entity")
        real = free.join(state.select("kind", F.col("entity").alias("replacement")), ["kind", "replacement"], "left_semi").select("kind", "entity")
        again = materialize(shared.union(real).distinct(), "surrogate-collisions")
        if again.isEmpty():
            return state.select("kind", "entity", "replacement")
        redrawn = state.join(again, ["kind", "entity"]).withColumn("attempt", F.col("attempt") + 1).withColumn("replacement", drawn("kind", "entity", "gender", "attempt"))
        state = materialize(state.join(again, ["kind", "entity"], "left_anti").unionByName(redrawn.select(*state.columns)), "surrogates")


def replacements(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, kind, start, end, surrogate of every mention."""
    import pandas as pd

    found = materialize(find_mentions(docs), "mentions")

    def write(surface, kind, entity):
        return pd.Series([render(s, k, e) for s, k, e in zip(surface, kind, entity, strict=True)], dtype=object)

    write.__annotations__ = {"surface": pd.Series, "kind": pd.Series, "entity": pd.Series, "return": pd.Series}
    chosen = found.join(assign_surrogates(found, key), ["kind", "entity"])
    return chosen.select("doc_id", "kind", "start", "end", F.pandas_udf(write, "string")("surface", "kind", "replacement").alias("surrogate"))


def replace_pii(docs: DataFrame, key: str) -> DataFrame:
    """docs with every mention replaced in its text; rows without an id, and other texts under an id, are replaced too."""
    import pandas as pd

    # changes belong to a text, so that rows with one id or none get their own
    keyed = docs.withColumn("__text", F.struct(F.xxhash64("text"), F.xxhash64("text", F.lit(1))))
    own = keyed.select(F.col("__text").alias("doc_id"), "text").where("text is not null").dropDuplicates(["doc_id"])
    number = materialize(own.select("doc_id", "text", F.monotonically_increasing_id().alias("n")), "pii-texts")
    by_text = replacements(number.select(F.col("n").alias("doc_id"), "text"), key).groupBy(F.col("doc_id").alias("n")).agg(F.array_sort(F.collect_list(F.struct("start", "end", "surrogate"))).alias("__changes"))
    by_text = number.join(by_text, "n").select(F.col("doc_id").alias("__text"), "__changes")

    def change(text, changes):
        out = []
        for t, c in zip(text, changes, strict=True):
            if t is not None and c is not None and len(c):
                parts, at = [], 0
                for s in c:
                    parts += [t[at : s["start"]], s["surrogate"]]
                    at = s["end"]
                t = "".join([*parts, t[at:]])
            out.append(t)
        return pd.Series(out, dtype=object)

    change.__annotations__ = {"text": pd.Series, "changes": pd.Series, "return": pd.Series}
    return keyed.join(by_text, "__text", "left").withColumn("text", F.pandas_udf(change, "string")("text", "__changes")).select(*docs.columns)
