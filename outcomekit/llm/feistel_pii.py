"""Format-preserving pseudonyms for personal data (operator 6).

Validated values are replaced by a keyed permutation of their own format, a
Feistel network over their digits, letters, address bits or days: equal values
get equal pseudonyms in all documents, different values different ones, and a
pseudonym passes the same validation as its value (by walking the cycle).
Punctuation, spacing and the order of a date's parts stay as they are.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomekit.llm.common import table

KEY = b"change-me"           # a secret of the caller in production
ROUNDS = 10
KINDS = ("card", "phone", "ip", "ssn", "iban", "date", "email")
MEMO = 100_000


# ---- permutations -------------------------------------------------------

def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """Keyed permutation of range(size): an alternating Feistel network over
    the mixed-radix halves of a slightly larger domain, walked back into range."""
    if size < 2:
        return value
    a = max(2, int(size ** 0.5))
    while a * a < size:
        a += 1
    b = -(-size // a)                                    # a * b >= size
    label = f"{tweak}/{size}/".encode()
    while True:
        left, right = divmod(value, b)                   # left < a, right < b
        for r in range(ROUNDS):
            source, limit = (right, a) if r % 2 == 0 else (left, b)
            h = hashlib.blake2b(label + b"%d/%d" % (r, source), key=key, digest_size=16).digest()
            shift = int.from_bytes(h, "big") % limit
            if r % 2 == 0:
                left = (left + shift) % a
            else:
                right = (right + shift) % b
        value = left * b + right
        if value < size:
            return value


def _walk(value: int, size: int, key: bytes, tweak: str, valid: Callable[[int], bool]) -> int:
    """Permutation of the valid values only."""
    while True:
        value = permute(value, size, key, tweak)
        if valid(value):
            return value


def luhn_digit(payload: str) -> int:
    """Check digit that makes payload + digit pass the mod-10 test."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def iban_check(country: str, account: str) -> int:
    digits = "".join(str(int(c, 36)) for c in account + country + "00")
    return 98 - int(digits) % 97


def _valid_ssn(n: int) -> bool:
    area, group, serial = n // 1_000_000, n // 10_000 % 100, n % 10_000
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


# ---- formats ------------------------------------------------------------

FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
TAIL = r"(?![\w@]|[-.]\d)"
# Where a value may start.  Cards and IBANs are only begun here: their ends are tried by validation.
PATTERN = re.compile(
    r"(?<![\w.@+-])(?:"
    r"(?P<email>[A-Za-z0-9][A-Za-z0-9._+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})" + TAIL +
    r"|(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2})"
    r"|(?P<iso>\d{4}-\d{2}-\d{2})(?:(?=[Tt]\d{2}(?::?\d{2}|\b))|" + TAIL + r")"
    r"|(?P<dmy>\d{1,2}[./]\d{1,2}[./]\d{4})" + TAIL +
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})" + TAIL +
    r"|(?P<ip>\d{1,3}(?:\.\d{1,3}){3})" + TAIL +
    r"|(?P<phone>(?:\+\d{1,2} ?)?\(\d{3}\) ?\d{3}-\d{4}|\+\d{1,2}[ -]\d{3}[ -]\d{3}[ -]\d{4}|\d{3}-\d{3}-\d{4})" + TAIL +
    r"|(?P<card>\d(?:[ -]?\d){12})"
    r")")
CARD = re.compile(r"\d(?:[ -]?\d){12,18}")
IBAN = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")
# Characters of an IBAN by country (SWIFT registry)
IBAN_CHARS = {c: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in codes.split()}


def _ends(text: str, start: int, run: re.Pattern, least: int, exact: int | None = None) -> Iterator[int]:
    """Ends of a value at ``start`` at a separator or before other text, longest
    first: of ``least`` characters without separators, or of ``exact`` ones."""
    m = run.match(text, start)
    if not m:
        return
    size = sum(c not in " -" for c in m.group())
    for end in range(m.end(), start, -1):
        if size < least:
            return
        if text[end - 1] in " -":
            continue
        after = text[end:end + 2]
        joined = after[:1].isalnum() or after[:1] in ("_", "@") or (after[:1] == "." and after[1:].isdigit())
        if not joined and exact in (None, size):
            yield end
        size -= 1


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced, in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


class Pseudonyms:
    """value -> (kind, pseudonym), or None where validation fails."""

    def __init__(self, key: bytes):
        self.key, self.memo = key, {}

    def digits(self, s: str, tweak: str) -> str:
        return str(permute(int(s), 10 ** len(s), self.key, f"{tweak}{len(s)}")).zfill(len(s))

    def card(self, v: str) -> str | None:
        d = re.sub(r"\D", "", v)
        if int(d[-1]) != luhn_digit(d[:-1]) or len(set(d)) == 1:
            return None
        # the issuer's first digit stays; the check digit follows from the rest
        body = d[0] + self.digits(d[1:-1], "card" + d[0])
        return _refill(v, body + str(luhn_digit(body)))

    def phone(self, v: str) -> str:
        head, tail = (v.split("(", 1) if "(" in v else ("", v)) if not re.match(r"\+\d{1,2}[ -]\d", v) else re.match(r"(\+\d{1,2}[ -])(.*)", v).groups()
        return head + ("(" if "(" in v else "") + _refill(tail, self.digits(re.sub(r"\D", "", tail), "phone"))

    def ip(self, v: str) -> str | None:
        parts = v.split(".")
        if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
            return None
        n = 0
        for p in parts:
            n = n << 8 | int(p)
        n = permute(n, 1 << 32, self.key, "ip")
        return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))

    def ssn(self, v: str) -> str | None:
        n = int(v.replace("-", ""))
        return _refill(v, f"{_walk(n, 10 ** 9, self.key, 'ssn', _valid_ssn):09d}") if _valid_ssn(n) else None

    def iban(self, v: str) -> str | None:
        s = v.replace(" ", "")
        country, account = s[:2], s[4:]
        if int(s[2:4]) != iban_check(country, account) or len(s) < 15:
            return None
        kind = "".join("9" if c.isdigit() else "A" for c in account)
        size, n = 1, 0
        for c, k in zip(account, kind):
            r = 10 if k == "9" else 26
            n, size = n * r + (int(c) if k == "9" else ord(c) - 65), size * r
        n, out = permute(n, size, self.key, "iban" + country + kind), ""
        for k in reversed(kind):
            n, d = divmod(n, 10 if k == "9" else 26)
            out = (str(d) if k == "9" else chr(65 + d)) + out
        it = iter(country + f"{iban_check(country, out):02d}" + out)
        return "".join(c if c == " " else next(it) for c in v)

    def _day(self, y: int, m: int, d: int) -> datetime.date | None:
        try:
            n = datetime.date(y, m, d).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= n <= LAST_DAY:
            return None
        return datetime.date.fromordinal(FIRST_DAY + permute(n - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, self.key, "date"))

    def iso(self, v: str) -> str | None:
        day = self._day(*map(int, v.split("-")))
        return day.isoformat() if day else None

    def dmy(self, v: str) -> str | None:
        a, sep, b, y = re.fullmatch(r"(\d+)([./])(\d+)[./](\d+)", v).groups()
        day = self._day(int(y), int(b), int(a))
        if day:
            return f"{day.day:02d}{sep}{day.month:02d}{sep}{day.year:04d}"
        day = self._day(int(y), int(a), int(b))          # month first
        return f"{day.month:02d}{sep}{day.day:02d}{sep}{day.year:04d}" if day else None

    def email(self, v: str) -> str:
        """Letters and digits of the local part; the domain stays."""
        local, domain = v.lower().split("@")
        size, n = 1, 0
        shape = ["9" if c.isdigit() else "a" if c.isalpha() else c for c in local]
        for c, k in zip(local, shape):
            if k in "9a":
                r = 10 if k == "9" else 26
                n, size = n * r + (int(c) if k == "9" else ord(c) - 97), size * r
        n, out = permute(n, size, self.key, "email" + "".join(shape)), []
        for k in reversed(shape):
            if k in "9a":
                n, d = divmod(n, 10 if k == "9" else 26)
                k = str(d) if k == "9" else chr(97 + d)
            out.append(k)
        return "".join(reversed(out)) + v[v.index("@"):]

    def of(self, form: str, value: str) -> tuple[str, str] | None:
        if (form, value) not in self.memo:
            if len(self.memo) > MEMO:
                self.memo.clear()
            new = getattr(self, form)(value)
            kind = "date" if form in ("iso", "dmy") else form
            self.memo[form, value] = (kind, new) if new is not None else None
        return self.memo[form, value]

    def at(self, text: str, m: re.Match) -> tuple[int, tuple[str, str]] | None:
        """End, kind and pseudonym of the longest valid value where ``m`` starts."""
        form, start = m.lastgroup, m.start()
        if form not in ("card", "iban") and (got := self.of(form, m.group())):
            return m.end(), got
        if form == "iban":
            country = text[start:start + 2]
            ends = _ends(text, start, IBAN, 15, IBAN_CHARS.get(country))
        else:
            form, ends = "card", _ends(text, start, CARD, 13)
        return next(((end, got) for end in ends if (got := self.of(form, text[start:end]))), None)


def pseudonymise(text: str, known: Pseudonyms) -> tuple[str, dict[str, int], list[str]]:
    """The text with pseudonyms, counts by kind, and the pseudonyms in order.
    Where nothing valid starts, the search goes on at the next character."""
    counts, made, out = dict.fromkeys(KINDS, 0), [], []
    done = at = 0
    while m := PATTERN.search(text, at):
        got = known.at(text, m)
        if got is None:
            at = m.start() + 1
            continue
        end, (kind, new) = got
        counts[kind] += 1
        made.append(new)
        out += text[done:m.start()], new
        done = at = end
    return "".join(out) + text[done:], counts, made


def _apply(key: bytes):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Pseudonyms(key)
        for b in batches:
            done = [pseudonymise(t, known) for t in b.column("t").to_pylist()]
            yield pa.record_batch(
                [b.column("id"), pa.array([d[0] for d in done], pa.string()), pa.array([d[2] for d in done], pa.list_(pa.string())),
                 *[pa.array([d[1][k] for d in done], pa.int32()) for k in KINDS]],
                names=["id", "text", "pseudonyms", *KINDS])
    return apply


def pseudonymise_documents(docs: DataFrame, key: bytes = KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, pseudonyms`` and a count for each kind.  Null texts count as
    empty; texts without a validated value come back as they are."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
    return src.mapInArrow(_apply(key), "id long, text string, pseudonyms array<string>, " + ", ".join(f"{k} int" for k in KINDS))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pseudonymise_documents(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "text", *[F.col(k).alias(f"n_{k}") for k in KINDS], "pseudonyms")
