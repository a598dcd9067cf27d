"""Personal data becomes format-preserving pseudonyms.

Card numbers, phone numbers, social security numbers, IP addresses, dates and
mail addresses are found, validated, and replaced by a keyed permutation of
the set of all valid values of their format. The permutation is a Feistel
network over bits; results outside of the set are permuted again until they
are inside, so it stays one to one. Equal values have equal pseudonyms in all
documents, however they are punctuated, and the punctuation stays.

Digits behind or before a card may stand as near as its own groups. So the usual
lengths for a card's beginning are tried first, at the ends of groups, then the other
kinds, then other card lengths; where nothing is valid the search goes on at
the next group.

Null texts stay null, empty ones empty. Columns other than the text
and the added counts pass through untouched. Repeated rows give repeated results. Work is per row, in
Arrow batches; nothing is shuffled, and a lost task is only run again.
"""

import datetime
import hashlib
import re
import secrets
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinflow.llm.common import free_name

ROUNDS = 8
KINDS = ("mail", "ip", "date", "ssn", "phone", "card")

MAIL = re.compile(r"(?<![A-Za-z0-9._%+\-])([A-Za-z0-9][A-Za-z0-9._%+\-]{0,63})@((?:[A-Za-z0-9][A-Za-z0-9\-]{0,62}\.){1,8})([A-Za-z]{2,24})(?![A-Za-z0-9])")
AFTER = r"(?:(?!\w)|(?=T\d\d:?\d\d)|(?=Z(?!\w)))"  # a time may stand behind a date
PATTERNS = {
    "ip": r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\w]|\.\d)",
    "date": rf"(?:(?:19|20)\d\d[-/](?:0[1-9]|1[0-2])[-/](?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[./](?:0[1-9]|[12]\d|3[01])[./](?:19|20)\d\d){AFTER}",
    "ssn": r"\d{3}-\d{2}-\d{4}(?![\w]|-\d)",
    "phone": r"(?:\+?1[ .\-]?)?(?:\([2-9]\d\d\)|[2-9]\d\d)[ .\-]?[2-9]\d\d[ .\-]?\d{4}(?!\w)",
}
KIND = {k: re.compile(p) for k, p in PATTERNS.items()}
CARD = r"\d(?:[ \-]?\d){12}"
# where a value may begin; a card may also follow a hyphen
START = re.compile(rf"(?<![\w.+])(?:(?<!-)(?:{'|'.join(PATTERNS.values())})|{CARD})")
RUN = re.compile(r"\d(?:[ \-]?\d){12,18}")
GROUP = re.compile(r"(?<!\d)\d+(?![\w])")
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY


def permuted(x: int, n: int, key: bytes, label: str) -> int:
    """The place of ``x`` in a keyed permutation of 0 .. n - 1."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = x >> half, x & mask
        for i in range(ROUNDS):
            mac = hashlib.blake2b(f"{label}:{n}:{i}:{right}".encode(), key=key, digest_size=16).digest()
            left, right = right, left ^ (int.from_bytes(mac, "big") & mask)
        x = (left << half) | right
        if x < n:
            return x


def refill(pattern: str, digits: str) -> str:
    """``pattern`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in pattern)


def luhn(payload: str) -> str:
    """The check digit that follows ``payload``."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def card(text: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", text)
    if luhn(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    size = len(digits) - 1
    payload = str(permuted(int(digits[:-1]), 10**size, key, "card")).zfill(size)
    return refill(text, payload + luhn(payload))


def lengths(digits: str) -> tuple[int, ...]:
    """How many digits cards with this beginning have, the usual number first."""
    if digits[0] == "4":
        return 16, 19, 13
    if digits[:2] in ("34", "37"):
        return (15,)
    if digits[:2] in ("30", "36", "38", "39"):
        return 14, 16
    if digits[:2] == "35" or digits[0] in "56":
        return 16, 19
    return (16,) if 2221 <= int(digits[:4]) <= 2720 else ()


def cards(text: str, at: int) -> tuple[list[str], list[str]]:
    """Spans of valid cards that begin at ``at`` and end with a group of digits.

    First those of a length usual for their beginning whose first group has four
    digits or more, then all others: the longest one, and shorter ones in
    groups of three digits or more.
    """
    run = RUN.match(text, at)
    if not run:
        return [], []
    by_size, whole, longest = {}, True, 0
    for g in GROUP.finditer(text, at, min(len(text), run.end() + 1)):
        span = text[at : g.end()]
        whole &= len(g[0]) >= 3
        n = sum(c.isdigit() for c in span)
        if n > 19 or g.end() > run.end():
            break
        longest = max(longest, n)
        by_size[n] = span, whole
    valid = {n: (span, whole) for n, (span, whole) in by_size.items() if n >= 13 and card(span, b"")}
    usual = [valid[n][0] for n in lengths(re.sub(r"\D", "", run[0])) if n in valid and run[0][:4].isdigit()]
    rest = [valid[n][0] for n in sorted(valid, reverse=True) if valid[n][0] not in usual and (n == longest or valid[n][1])]
    return usual, rest


def phone(text: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", text)
    head, own = digits[:-10], digits[-10:]
    x = ((int(own[:3]) - 200) * 800 + int(own[3:6]) - 200) * 10_000 + int(own[6:])
    x, line = divmod(permuted(x, 800 * 800 * 10_000, key, "phone"), 10_000)
    area, office = divmod(x, 800)
    return refill(text, f"{head}{area + 200}{office + 200}{line:04d}")


def ssn(text: str, key: bytes) -> str | None:
    area, group, serial = (int(x) for x in text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    x, serial = divmod(permuted(x, 898 * 99 * 9999, key, "ssn"), 9999)
    area, group = divmod(x, 99)
    area += 1 + (area >= 665)
    return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"


def ip(text: str, key: bytes) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255:
        return None
    x = permuted(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ip")
    return ".".join(str(b) for b in x.to_bytes(4, "big"))


def _day(year: int, month: int, day: int) -> datetime.date | None:
    try:
        return datetime.date(year, month, day)
    except ValueError:
        return None


def date(text: str, key: bytes) -> str | None:
    """Year first, or day first with points: one permutation of days, so both stay linked. With slashes
    and the year last, either order of day and month makes a date; these are permuted among themselves."""
    if text[2] in "./" and text[5] != text[2]:
        return None
    if text[2] == "/":
        return _either_way(text, key)
    first = text[2] == "."
    day = _day(int(text[6:]), int(text[3:5]), int(text[:2])) if first else _day(int(text[:4]), int(text[5:7]), int(text[8:]))
    if day is None:
        return None
    new = datetime.date.fromordinal(FIRST_DAY + permuted(day.toordinal() - FIRST_DAY, DAYS, key, "date"))
    if first:
        return f"{new.day:02d}.{new.month:02d}.{new.year:04d}"
    return f"{new.year:04d}{text[4]}{new.month:02d}{text[7]}{new.day:02d}"


def _either_way(text: str, key: bytes) -> str | None:
    a, b, year = int(text[:2]), int(text[3:5]), int(text[6:])
    if not (_day(year, a, b) or _day(year, b, a)):
        return None
    x = ((year - 1900) * 31 + a - 1) * 31 + b - 1
    while True:  # on until it is a date again
        x = permuted(x, 200 * 31 * 31, key, "slashes")
        year, a, b = 1900 + x // 961, x // 31 % 31 + 1, x % 31 + 1
        if _day(year, a, b) or _day(year, b, a):
            return f"{a:02d}/{b:02d}/{year:04d}"


def spelled(text: str, key: bytes, label: str) -> str:
    """Letters and digits permuted together, each place within its kind."""
    base = [26 if c.isalpha() else 10 if c.isdigit() else 1 for c in text]
    n, x = 1, 0
    for c, b in zip(text, base, strict=True):
        n, x = n * b, x * b + (ord(c.lower()) - 97 if b == 26 else int(c) if b == 10 else 0)
    x = permuted(x, n, key, label) if n > 1 else 0
    out = []
    for c, b in zip(reversed(text), reversed(base), strict=True):
        x, d = divmod(x, b)
        out.append(chr(d + (65 if c.isupper() else 97)) if b == 26 else str(d) if b == 10 else c)
    return "".join(reversed(out))


VALID = {"card": card, "phone": phone, "ssn": ssn, "ip": ip, "date": date}


def pseudonymise(text: str, key: bytes) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and how many of each kind."""
    found: dict[str, int] = {}

    def mail(m: re.Match) -> str:
        found["mail"] = found.get("mail", 0) + 1
        return f"{spelled(m[1], key, 'mail')}@{spelled(m[2], key, 'host')}{m[3]}"

    def value(part: str, at: int, others: bool = True) -> tuple[str, str] | None:
        """Kind and span of the value that begins here; with ``others``, unusual cards too."""
        hyphen = at > 0 and part[at - 1] == "-"
        usual, rest = cards(part, at)
        for kind in () if hyphen else ("ip", "date", "ssn"):
            m = KIND[kind].match(part, at)
            if m and VALID[kind](m[0], key) is not None:
                return kind, m[0]
        if usual:
            return "card", usual[0]
        m = None if hyphen else KIND["phone"].match(part, at)
        if m:
            return "phone", m[0]
        if not others or hyphen:
            return None
        for span in rest:
            # digits in front of another value may make up a valid number by chance
            inner = (at + k.start() for k in GROUP.finditer(span) if k.start())
            if not any(START.match(part, k) and value(part, k, False) for k in inner):
                return "card", span
        return None

    def numbers(part: str) -> str:
        out, done, at = [], 0, 0
        while m := START.search(part, at):
            got = value(part, m.start())
            if got is None:
                at = m.start() + 1
                continue
            kind, span = got
            out += [part[done : m.start()], VALID[kind](span, key)]
            found[kind] = found.get(kind, 0) + 1
            done = at = m.start() + len(span)
        return "".join([*out, part[done:]])

    # addresses stand aside, so that their new digits are not taken for numbers
    parts, at = [], 0
    for m in MAIL.finditer(text) if "@" in text else ():
        parts += [numbers(text[at : m.start()]), mail(m)]
        at = m.end()
    return "".join([*parts, numbers(text[at:])]), found


_OWN_KEYS: dict[str, bytes] = {}


def secret(spark: SparkSession) -> bytes:
    """The key in ``spark.twinflow.pii.key``; where there is none, one drawn for this application, which nobody can use again."""
    given = spark.conf.get("spark.twinflow.pii.key", None)
    if given:
        return hashlib.blake2b(given.encode(), digest_size=32).digest()
    return _OWN_KEYS.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


def pseudonyms(docs: DataFrame, text: str = "text", key: bytes | None = None, counts: bool = True) -> DataFrame:
    """The input with its text replaced, and ``n_<kind>`` columns if ``counts``; input columns of these names are replaced.

    Without ``key`` the one of ``secret`` is taken. Keep it to find equal values again in later runs.
    """
    import pandas as pd

    key = secret(docs.sparkSession) if key is None else key
    new_name = free_name(docs, "new")
    shape = ", ".join(["text string", *(f"n_{k} int" for k in KINDS)])

    @F.pandas_udf(shape)
    def replaced(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch:
                new, n = (None, {}) if t is None else pseudonymise(t, key)
                rows.append((new, *(n.get(k, 0) for k in KINDS)))
            yield pd.DataFrame(rows, columns=["text", *(f"n_{k}" for k in KINDS)])

    out = docs.withColumn(new_name, replaced(F.col(f"`{text}`")))
    out = out.withColumn(text, F.col(new_name)["text"])
    if counts:
        out = out.withColumns({f"n_{k}": F.col(new_name)[f"n_{k}"] for k in KINDS})
    return out.drop(new_name)
