"""Format-preserving pseudonyms for personal data in texts.

Numbers and dates that pass their own validity rule are replaced by others of the same form: a keyed
Feistel network permutes all values of a form, walking on while the result is not valid. Being a permutation,
it gives equal values equal pseudonyms in all documents and different values different ones,
whatever separators they are written with. Digits move, separators stay.

Forms: payment cards (13 to 19 digits, Luhn; the check digit is computed anew), international bank account
numbers (length of the country and mod 97; country stays, check digits anew), IPv4 addresses, telephone numbers with a country code
(which stays) or in the (ddd) ddd-dddd and ddd-ddd-dddd forms, social security numbers, dates of 1900 to 2099
(permuted as days) in numbers or with the name of the month, and the letters and digits of the local part of e-mail addresses.
A value is permuted in one plain form, without separators, capitals or the order of its parts, and then written as it was found.

Numbers that fail their rule are left as they are. Defined cases: a missing text stays missing; texts are read
whole; repeated rows are rewritten each; columns of any name are kept, ``n_replaced`` is set here.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: For tests and the registered query; a real run passes its own secret.
DEMO_KEY = b"not a secret"
ROUNDS = 10
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY


def feistel(value: int, size: int, key: bytes, form: str) -> int:
    """A keyed permutation of 0 to size - 1: a balanced Feistel network, walked until it is back in range."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for r in range(ROUNDS):
            seed = hashlib.blake2b(right.to_bytes(width, "big"), digest_size=min(64, width + 8), key=key[:64], salt=bytes([r]), person=hashlib.blake2b(form.encode(), digest_size=16).digest()).digest()
            if width > 64:  # more digits than one hash has
                seed = hashlib.shake_256(seed).digest(width)
            left, right = right, left ^ (int.from_bytes(seed, "big") & mask)
        value = (left << half) | right
        if value < size:
            return value


def move_digits(digits: str, key: bytes, form: str) -> str:
    n = len(digits)
    return f"{feistel(int(digits), 10**n, key, f'{form}{n}'):0{n}d}"


def luhn_digit(payload: str) -> str:
    """The check digit behind ``payload``."""
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(payload)))
    return str(-total % 10)


def put_digits(form: str, digits: str) -> str:
    """``form`` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in form)


def card(found: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", found)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or not digits.strip("0"):
        return None
    payload = move_digits(digits[:-1], key, "card")
    return put_digits(found, payload + luhn_digit(payload))


#: Country codes of one and two digits; all others have three. Fixed values.
SHORT_CODES = {"1", "7"} | set(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)


def country_code(digits: str) -> str:
    return next((digits[:n] for n in (1, 2) if digits[:n] in SHORT_CODES), digits[:3])


def phone(found: str, key: bytes) -> str | None:
    """A number without a country code is one of country 1."""
    digits = re.sub(r"\D", "", found)
    if not 8 <= len(digits) <= 15:
        return None
    code = country_code(digits) if found.startswith("+") else ""
    own = digits[len(code) :]
    return put_digits(found, code + move_digits(own, key, f"phone{code or '1'}-"))


def address(found: str, key: bytes) -> str | None:
    octets = [int(x) for x in found.split(".")]
    if max(octets) > 255:
        return None
    moved = feistel(int.from_bytes(bytes(octets), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, moved.to_bytes(4, "big")))


def _social(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


def social(found: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", found)
    if not _social(digits):
        return None
    digits = move_digits(digits, key, "ssn")
    while not _social(digits):
        digits = move_digits(digits, key, "ssn")
    return put_digits(found, digits)


def _day(year: int, month: int, day: int) -> datetime.date | None:
    try:
        date = datetime.date(year, month, day)
    except ValueError:
        return None
    return date if 1900 <= year < 2100 else None


def date(found: str, key: bytes) -> str | None:
    parts = re.split(r"\D", found)
    numbers = [int(p) for p in parts]
    for order in ((0, 1, 2),) if len(parts[0]) == 4 else ((2, 1, 0), (2, 0, 1)):
        day = _day(*(numbers[i] for i in order))
        if day:
            new = datetime.date.fromordinal(FIRST_DAY + feistel(day.toordinal() - FIRST_DAY, DAYS, key, "date"))
            fields = dict(zip(order, (new.year, new.month, new.day), strict=True))
            separators = re.findall(r"\D", found)
            text = [f"{fields[i]:0{len(parts[i])}d}" for i in range(3)]
            return text[0] + separators[0] + text[1] + separators[1] + text[2]
    return None


#: Names of the months, and short ones, as they are written in texts. Fixed values.
MONTHS = (
    ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"),
    ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"),
    ("januar", "februar", "märz", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "dezember"),
    ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"),
    ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"),
)


def named_date(found: re.Match, key: bytes) -> str | None:
    """A date with the name of its month, which is replaced by one of the same list; lists are tried in order."""
    name = found["month"]
    names = next(m for m in MONTHS if name.lower() in m)
    day = _day(int(found["year"]), names.index(name.lower()) + 1, int(found["day"]))
    if not day:
        return None
    new = datetime.date.fromordinal(FIRST_DAY + feistel(day.toordinal() - FIRST_DAY, DAYS, key, "date"))
    month = names[new.month - 1]
    month = month.upper() if name.isupper() else month.capitalize() if name[0].isupper() else month
    parts = {"day": f"{new.day:0{2 if found['day'][0] == '0' else 1}d}", "month": month, "year": str(new.year)}
    out, at = [], found.start()
    for part in sorted(parts, key=found.start):
        out += [found.string[at : found.start(part)], parts[part]]
        at = found.end(part)
    return "".join([*out, found.string[at : found.end()]])


#: Characters of an account number by country. Fixed values.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28,
    "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23,
    "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32,
    "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18,
    "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}


def iban(found: str, key: bytes) -> str | None:
    """The pseudonym of the account number that ``found`` begins with, as long as that of its country is."""
    length = IBAN_LENGTHS.get(found[:2])
    places = [i for i, c in enumerate(found) if c != " "]
    if length is None or len(places) < length:
        return None
    found, behind = found[: places[length - 1] + 1], found[places[length - 1] + 1 :]
    plain = found.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if behind[:1] not in ("", " ") or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = move_characters(plain[4:], key, "iban" + plain[:2])
    new = iter(plain[:2] + f"{98 - number(body + plain[:2] + '00') % 97:02d}" + body)
    return "".join(c if c == " " else next(new) for c in found)


_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def move_characters(text: str, key: bytes, form: str) -> str:
    """Letters and digits permuted within their alphabets, all together; other characters stay."""
    sets = [next((a for a in _ALPHABETS if c in a), c) for c in text]
    value, size = 0, 1
    for c, a in zip(text, sets, strict=True):
        value, size = value * len(a) + a.index(c), size * len(a)
    shape = "".join(a[0] for a in sets)
    value = feistel(value, size, key, f"{form}:{shape}") if size > 1 else value
    out = []
    for a in reversed(sets):
        value, at = divmod(value, len(a))
        out.append(a[at])
    return "".join(reversed(out))


def email(found: str, key: bytes) -> str:
    """Capitals are no part of the value; they stay where they are."""
    local, domain = found.rsplit("@", 1)
    new = move_characters(local.lower(), key, "mail@" + domain.lower())
    return "".join(n.upper() if c.isupper() else n for c, n in zip(local, new, strict=True)) + "@" + domain


#: What may be a number or a date: a run of digits and separators.
_RUN = re.compile(r"[+(\d][\d .()/+-]{5,}\d")
_FORMS = re.compile(
    r"(?P<date>(?<![\w./-])(?:\d{4}(?P<a>[/-])\d{1,2}(?P=a)\d{1,2}|\d{1,2}(?P<b>[./-])\d{1,2}(?P=b)\d{4})(?![\w/-]))"
    r"|(?P<address>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))"
    r"|(?P<social>(?<![\w-])(?<!\d )\d{3}(?P<c>[ -])\d{2}(?P=c)\d{4}(?![\w-])(?! \d))"
    r"|(?P<card>(?<![\w-])(?:\d{13,19}|\d{4}(?P<d>[ -])\d{4}(?P=d)\d{4}(?P=d)\d{1,7}|\d{4}(?P<e>[ -])\d{6}(?P=e)\d{5})(?![\w-]))"
    r"|(?P<phone>(?<![\w+])\+\d{8,15}(?!\w|\.\d)|(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]\d{2,8}){1,4}(?!\w|\.\d)|(?<!\w)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-]))"
)
_MONTH = "|".join(sorted({name for names in MONTHS for name in names}, key=lambda n: (-len(n), n)))
_NAMED = (
    re.compile(rf"(?<![\w./-])(?P<day>\d{{1,2}})(?:\.|st|nd|rd|th)? (?:de )?(?P<month>{_MONTH})\.?,? (?:de )?(?P<year>(?:19|20)\d\d)(?!\w)", re.IGNORECASE),
    re.compile(rf"(?<!\w)(?P<month>{_MONTH})\.? (?P<day>\d{{1,2}})(?:st|nd|rd|th)?,? (?P<year>(?:19|20)\d\d)(?!\w)", re.IGNORECASE),
)
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}")
_YEAR = re.compile(r" (?:19|20)\d\d(?!\w)")
_MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_RULES: dict[str, Callable[[str, bytes], str | None]] = {"date": date, "address": address, "social": social, "card": card, "phone": phone}


def find(text: str, key: bytes) -> list[tuple[int, int, str]]:
    """(begin, end, pseudonym) of all personal data in the text, in order, without overlaps."""
    spans = []
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin and (c := text[begin - 1]).isascii() and (c.isalnum() or c in "._%+-"):
            begin -= 1
        m = _MAIL.match(text, begin)
        if m and m.end() > at + 1:
            spans.append((begin, m.end(), email(m[0], key)))
        at = text.find("@", m.end() if m else at + 1)
    pos = 0
    while m := _IBAN.search(text, pos):
        new = iban(m[0], key)
        pos = m.start() + (1 if new is None else len(new))
        if new is not None and not text[pos : pos + 1].isalnum():
            spans.append((m.start(), pos, new))
    if _YEAR.search(text):
        for form in _NAMED:
            spans += [(*m.span(), new) for m in form.finditer(text) if (new := named_date(m, key)) is not None]
    for run in _RUN.finditer(text):
        pos = max(0, run.start() - 1)
        while m := _FORMS.search(text, pos, run.end() + 2):
            new = _RULES[m.lastgroup](m[0], key)
            if new is not None:
                spans.append((*m.span(), new))
            pos = m.start() + 1 if new is None else m.end()
    out, last = [], 0
    for begin, end, new in sorted(spans, key=lambda s: (s[0], -s[1])):
        if begin >= last:
            out.append((begin, end, new))
            last = end
    return out


def rewrite(text: str, key: bytes) -> tuple[str, int]:
    """(text, replacements)."""
    spans = find(text, key)
    if not spans:
        return text, 0
    parts, last = [], 0
    for begin, end, new in spans:
        parts += [text[last:begin], new]
        last = end
    return "".join([*parts, text[last:]]), len(spans)


def _rewrite(batches: Iterator[pa.RecordBatch], key: bytes, at: int) -> Iterator[pa.RecordBatch]:
    cached = functools.lru_cache(4096)(lambda text: rewrite(text, key))
    for batch in batches:
        done = [(None, 0) if t is None else cached(t) if len(t) < 4096 else rewrite(t, key) for t in batch.column(at).to_pylist()]
        columns = list(batch.columns)
        columns[at] = pa.array([d[0] for d in done], columns[at].type)
        yield pa.RecordBatch.from_arrays([*columns, pa.array([d[1] for d in done], pa.int64())], [*batch.schema.names, "n_replaced"])


def pseudonymise(docs: DataFrame, key: bytes = DEMO_KEY) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_replaced``."""
    docs = docs.drop("n_replaced").withColumn("text", F.col("text").cast("string"))
    at = docs.columns.index("text")
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    schema = StructType([*rows.schema.fields, StructField("n_replaced", LongType())])
    return rows.mapInArrow(lambda b: _rewrite(b, key, at), schema).toDF(*docs.columns, "n_replaced")
