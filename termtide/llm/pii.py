"""Pseudonyms for personal data: numbers, dates and names are permuted within their format.

A value that is valid for its kind (check digits, calendar, number ranges) is turned into a number
below the count of valid values of its format, moved by a keyed Feistel permutation of just
that range, and spelled in the same format again. Equal values get equal pseudonyms in all
documents without any table, so nothing is shuffled or remembered; different values of a format
never meet; and who holds the key can undo it.

Defined results: null and empty texts stay as they are; what looks like personal data but is
not valid stays; a card or account number that is not valid together with the short numbers or
capital words after it is tried without them, in the usual lengths and groups first (where the
pseudonym happens to be valid together with them, undoing takes the spans besides the key); all columns of the documents are returned, with the text replaced; repeated
documents give one row each.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import math
import re
from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase, digits

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termtide.llm.common import carried, columns_of, let_go, restored, small_batches, use_text_batches

ROUNDS = 10
BATCH_ROWS = 2_000
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
LAST_DAY = datetime.date(2099, 12, 31).toordinal()


class Feistel:
    """A keyed permutation of the numbers below `size`, for any size."""

    def __init__(self, key: bytes, kind: str, size: int) -> None:
        self._key, self._size = key, size
        self._label = f"{kind}/{size}/".encode()
        self._side = math.isqrt(size - 1) + 1 if size > 1 else 1

    def _mix(self, turn: int, half: int) -> int:
        said = self._label + b"%d/%d" % (turn, half)
        digest = hashlib.blake2b(said, key=self._key, digest_size=64).digest()
        return int.from_bytes(digest) % self._side

    def forward(self, number: int) -> int:
        # The square of the side may exceed the size; walking on until the result is below it
        # stays a permutation.
        while True:
            left, right = divmod(number, self._side)
            for turn in range(ROUNDS):
                left, right = right, (left + self._mix(turn, right)) % self._side
            number = left * self._side + right
            if number < self._size:
                return number

    def backward(self, number: int) -> int:
        while True:
            left, right = divmod(number, self._side)
            for turn in reversed(range(ROUNDS)):
                left, right = (right - self._mix(turn, left)) % self._side, left
            number = left * self._side + right
            if number < self._size:
                return number


Move = Callable[[str, int, int], int]  # kind, size, number -> number


def mover(key: bytes, back: bool = False) -> Move:
    def move(kind: str, size: int, number: int) -> int:
        cipher = Feistel(key, kind, size)
        return cipher.backward(number) if back else cipher.forward(number)

    return move


_SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType())])
    .add("start", T.LongType())
    .add("end", T.LongType())
)
_CLASSES = (digits, ascii_lowercase, ascii_uppercase)
_HEX = digits + ascii_lowercase[:6]


def _spelled_like(model: str, signs: str) -> str:
    """`signs` in the places of the letters and digits of `model`, its other characters kept."""
    left = iter(signs)
    return "".join(next(left) if c.isascii() and c.isalnum() else c for c in model)


def _signs(value: str) -> str:
    return "".join(c for c in value if c.isascii() and c.isalnum())


def _in_class(kind: str, signs: str, move: Move) -> str:
    """Digits become digits and letters letters of the same case."""
    classes = [next(c for c in _CLASSES if s in c) for s in signs]
    number = 0
    for sign, own in zip(signs, classes):
        number = number * len(own) + own.index(sign)
    number = move(kind, math.prod(map(len, classes)), number)
    made = []
    for own in reversed(classes):
        number, place = divmod(number, len(own))
        made.append(own[place])
    return "".join(reversed(made))


def luhn_digit(body: str) -> str:
    """The check digit that makes a card number of these leading digits valid."""
    total = 0
    for place, sign in enumerate(reversed(body)):
        digit = int(sign) * (2 if place % 2 == 0 else 1)
        total += digit - 9 if digit > 9 else digit
    return str(-total % 10)


def iban_digits(country: str, account: str) -> str:
    """The two check digits of an account number."""
    spelled = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(spelled) % 97:02d}"


def _card(value: str, move: Move) -> str | None:
    number = _signs(value)
    if luhn_digit(number[:-1]) != number[-1] or len(set(number)) == 1:
        return None
    body = _in_class("card", number[:-1], move)
    return _spelled_like(value, body + luhn_digit(body))


def _iban(value: str, move: Move) -> str | None:
    signs = _signs(value)
    country, check, account = signs[:2], signs[2:4], signs[4:]
    if iban_digits(country, account) != check:
        return None
    account = _in_class("iban", account, move)
    return _spelled_like(value, country + iban_digits(country, account) + account)


def _phone(value: str, move: Move) -> str | None:
    signs = _signs(value)
    country, number = signs[:-10], move("phone", 10**10, int(signs[-10:]))
    return _spelled_like(value, f"{country}{number:010d}")


def _ssn(value: str, move: Move) -> str | None:
    area, group, serial = map(int, value.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    number = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    number, serial = divmod(move("ssn", 898 * 99 * 9999, number), 9999)
    area, group = divmod(number, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _ipv4(value: str, move: Move) -> str | None:
    parts = [int(p) for p in value.split(".")]
    if max(parts) > 255:
        return None
    number = move("ipv4", 1 << 32, int.from_bytes(bytes(parts)))
    return ".".join(map(str, number.to_bytes(4)))


# Date formats, for each the order of year, month and day. Where a slashed date is
# none with the month first, the day is first.
_DATE_ORDERS = {"-": "ymd", ".": "dmy", "/": "mdy"}
_DAYS_BY_MONTH = 12  # days up to here can be read as a month


def _late_days(ordinal: int) -> int:
    """Days from FIRST_DAY on, up to and without this one, that cannot be read as a month."""
    day = datetime.date.fromordinal(ordinal)
    months = (day.year - 1900) * 12 + day.month - 1
    return ordinal - FIRST_DAY - _DAYS_BY_MONTH * months - min(day.day - 1, _DAYS_BY_MONTH)


def _day_first(given: dict[str, int], move: Move) -> str | None:
    """A slashed date with its day, above 12, first: it moves among dates that are like it.

    So it stays no date with the month first, and both readings can be undone.
    """
    try:
        day = datetime.date(given["y"], given["d"], given["m"])
    except ValueError:
        return None
    if not FIRST_DAY <= day.toordinal() <= LAST_DAY:
        return None
    number = move("date dmy", _late_days(LAST_DAY + 1), _late_days(day.toordinal()))
    found = bisect.bisect_right(range(FIRST_DAY, LAST_DAY + 2), number, key=_late_days)
    made = datetime.date.fromordinal(FIRST_DAY + found - 1)
    return f"{made.day:02d}/{made.month:02d}/{made.year:04d}"


def _date(value: str, move: Move) -> str | None:
    sign = next(c for c in value if not c.isdigit())
    order = _DATE_ORDERS[sign]
    given = dict(zip(order, map(int, value.split(sign))))
    try:
        day = datetime.date(given["y"], given["m"], given["d"]).toordinal()
    except ValueError:
        return _day_first(given, move) if order == "mdy" else None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    day = FIRST_DAY + move("date", LAST_DAY - FIRST_DAY + 1, day - FIRST_DAY)
    made = datetime.date.fromordinal(day)
    parts = {"y": f"{made.year:04d}", "m": f"{made.month:02d}", "d": f"{made.day:02d}"}
    return sign.join(parts[part] for part in order)


def _email(value: str, move: Move) -> str | None:
    name, _, host = value.partition("@")
    return f"{_spelled_like(name, _in_class('email', _signs(name), move))}@{host}"


def _secret(value: str, move: Move) -> str | None:
    if set(value) <= set(_HEX):
        number = move("hex", 16 ** len(value), int(value, 16))
        return f"{number:0{len(value)}x}"
    if set(value) <= set(_HEX.upper()):
        # Walking on to a number with a letter in it keeps both cases apart.
        number = int(value, 16)
        while True:
            number = move("hex", 16 ** len(value), number)
            made = f"{number:0{len(value)}X}"
            if not made.isdigit():
                return made
    return _spelled_like(value, _in_class("secret", _signs(value), move))


# A card number may have a short number, as an expiry date or code, after a hyphen.
_CARD_END = r"(?:(?!\w|[.-]\d)|(?=-\d{1,4}(?!\w|[.-]\d)))"

# What each kind looks like. Earlier kinds win where several match.
_LOOKS = {
    "email": r"(?<![\w.+@-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "date": r"(?<![\w./-])(?:\d{4}-\d\d-\d\d|\d\d\.\d\d\.\d{4}|\d\d/\d\d/\d{4})(?![\w/-]|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d\d-\d{4}(?![\w-])",
    "phone": r"(?<![\w+-])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])",
    "ipv4": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)",
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}" + _CARD_END,
    "secret": r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)"
    r"|(?i:(?<=password=)|(?<=token=)|(?<=token = \")|(?<=token=\")|(?<=secret=))[A-Za-z0-9]{12,}(?!\w)",
}
_MADE = {
    "email": _email,
    "iban": _iban,
    "date": _date,
    "ssn": _ssn,
    "phone": _phone,
    "ipv4": _ipv4,
    "card": _card,
    "secret": _secret,
}
# Kinds that may run on into the next words, and what must come after them.
_ENDS = {"iban": re.compile(r"(?!\w)", re.ASCII), "card": re.compile(_CARD_END, re.ASCII)}
_ALONE = {kind: re.compile(_LOOKS[kind], re.ASCII) for kind in _ENDS}
_CARD_SHAPE = re.compile(
    r"(?<![\w.-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,4}(?:\1\d{1,3})?|\d{4}([ -])\d{6}\2\d{4,5})"
    + _CARD_END,
    re.ASCII,
)
# More than the longest number of `_CARD_SHAPE` and what must follow it.
_CARD_REACH = 40
# Letters and digits of an account number, by country.
_IBAN_SIGNS = {
    country: size
    for size, countries in {
        15: "NO",
        16: "BE",
        18: "DK FI FK FO GL NL SD",
        19: "MK SI",
        20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST",
        26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA",
        30: "JO KW MU YE",
        31: "MT SC",
        32: "LC",
        33: "RU",
    }.items()
    for country in countries.split()
}
_LOOK = re.compile("|".join(f"(?P<{kind}>{look})" for kind, look in _LOOKS.items()), re.ASCII)
_HINT = re.compile(r"[0-9@=]+")  # the names of secrets end in "="
_NEAR_HINT = 24
_SECRET_PREFIX = "AKIA"
_SPACE = re.compile(r"\s")
_KEPT_PREFIX = {"secret": _SECRET_PREFIX}


def _hints(text: str) -> list[int]:
    hints = [match.start() for match in _HINT.finditer(text)]
    at = text.find(_SECRET_PREFIX)
    while at >= 0:
        hints.append(at + len(_SECRET_PREFIX))
        at = text.find(_SECRET_PREFIX, at + 1)
    return sorted(hints)


def _regions(text: str) -> list[tuple[int, int]]:
    """Whole words around digits, at-signs, equals signs and "AKIA"; nothing is found elsewhere."""
    regions: list[tuple[int, int]] = []
    last = 0
    for hint in _hints(text):
        if hint < last:
            continue
        first = max(0, hint - _NEAR_HINT)
        while first and not text[first - 1].isspace():
            first -= 1
        space = _SPACE.search(text, min(len(text), hint + _NEAR_HINT))
        last = space.start() if space else len(text)
        if regions and first <= regions[-1][1]:
            first = regions.pop()[0]
        regions.append((first, last))
    return regions


def _ends(kind: str, text: str, start: int, end: int, last: int) -> list[int]:
    """Where a value that starts at `start` and runs to `end` at most may end, best first."""
    if kind not in _ENDS:
        return [end]
    ends = [
        at
        for at in range(end, start, -1)
        if _ENDS[kind].match(text, at, last) and _ALONE[kind].fullmatch(text, start, at)
    ]
    if kind == "iban":
        usual = _IBAN_SIGNS.get(text[start : start + 2])
        ends.sort(key=lambda at: len(_signs(text[start:at])) != usual)
    else:
        ends.sort(key=lambda at: not _CARD_SHAPE.fullmatch(text, start, at))
    return ends


def _is_part(text: str, start: int, end: int, last: int) -> bool:
    """Whether a card number in unusual groups is one in usual groups with digits before it."""
    if _CARD_SHAPE.fullmatch(text, start, end):
        return False
    # A number that starts before `end` ends not far behind it.
    last = min(last, end + _CARD_REACH)
    later = _CARD_SHAPE.search(text, start + 1, last)
    while later and later.start() < end:
        number = _signs(later.group())
        if later.end() >= end and luhn_digit(number[:-1]) == number[-1]:
            return True
        later = _CARD_SHAPE.search(text, later.start() + 1, last)
    return False


def _pseudonym(
    kind: str, text: str, start: int, end: int, last: int, move: Move
) -> tuple[str, int] | None:
    """What to put in place of the value at `start`, and the end of the value."""
    kept = _KEPT_PREFIX.get(kind, "")
    kept = kept if text.startswith(kept, start) else ""
    for at in _ends(kind, text, start, end, last):
        new = _MADE[kind](text[start + len(kept) : at], move)
        if new is not None and not (kind == "card" and _is_part(text, start, at, last)):
            return kept + new, at
    return None


def replace(text: str, move: Move) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms and the spans `(kind, start, end)` replaced in it.

    Spans refer to the text that went in; only a network address can change in length.
    """
    made, spans, at = [], [], 0
    for first, last in _regions(text):
        looked = max(first, at)
        while match := _LOOK.search(text, looked, last):
            kind, start = match.lastgroup, match.start()
            found = _pseudonym(kind, text, start, match.end(), last, move)
            if found is None:
                # Not valid as this kind; another kind may begin within it.
                looked = start + 1
                continue
            new, end = found
            made += [text[at:start], new]
            spans.append((kind, start, end))
            at = looked = end
    return "".join([*made, text[at:]]) if spans else text, spans


def pseudonymize(
    docs: DataFrame, key: str, text_col: str = "text", spans_col: str | None = None
) -> DataFrame:
    """The documents with pseudonyms in the text; `spans_col` adds what was replaced.

    A column of the documents that is named like `spans_col` is replaced.
    """
    use_text_batches(docs.sparkSession)
    names = [name for name in docs.columns if name != spans_col]
    packed = carried(docs, text_col)
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    )
    schema = T.StructType([*packed.schema.fields, T.StructField("spans", _SPANS)])
    secret = hashlib.sha256(key.encode()).digest()

    def run(batches):
        let_go()
        move = mover(secret)
        for batch in small_batches(batches, BATCH_ROWS):
            texts, spans = [], []
            for text in columns_of(batch, "text")[0]:
                new, found = (None, []) if text is None else replace(text, move)
                texts.append(new)
                spans.append([dict(zip(("kind", "start", "end"), s)) for s in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string()), pa.array(spans, kind)],
                names=["row", "text", "spans"],
            )

    made = packed.mapInArrow(run, schema)
    added = [F.col("spans").alias(spans_col)] if spans_col else []
    return made.select(*restored(names, text_col), *added)
