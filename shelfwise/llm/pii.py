"""Personal data replaced by keyed surrogates of the same type, format, script and gender.

A surrogate follows from a secret key, the kind of the entity and its normal form alone, so one
entity gets the same surrogate in every text, and spellings that differ in punctuation or case only
share it. It is then put into the format found in the text.

Surrogates are checked over the whole corpus before any text is changed. Spark gathers the distinct
entities; where two of a kind get one surrogate, or a surrogate is itself an entity that occurs, all
but the least take the next attempt, until no clash is left. Entities that are not on their first
attempt are few (clashes among random draws); their table is sent to the tasks while it is
small, and joined with the texts beyond that.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.memory import fresh, released
from shelfwise.session import materialize

#: Entities beyond their first attempt that are sent to tasks; more are joined.
SENT = 50_000

MALE = ("Mr", "Herr", "Señor", "Sr", "Don", "M", "Monsieur", "Г-н", "Κος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Doña", "Mme", "Mlle", "Madame", "Г-жа", "Κα")
NEUTRAL = ("Dr", "Prof")
_TITLES = MALE + FEMALE + NEUTRAL
_NAME = r"[^\W\d_a-zà-öø-ÿ][^\W\d_]+(?:['’-][^\W\d_]+)*"
_PATTERNS = {
    "email": r"(?<![\w.+%-])[A-Za-z0-9_%+-](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![\w-])",
    "secret": r"(?:(?<=[^\w])|^)(?i:password|passwd|pwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?(?P<value>[A-Za-z0-9+/_.-]{7,}[A-Za-z0-9])",
    "key": r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w)",
    "ip": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\(\d{3}\)[ ]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])",
    "card": r"(?<![\w+-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "person": r"(?<!\w)(?P<title>" + "|".join(sorted(_TITLES, key=len, reverse=True)) + r")(?:\.[ ]?|[ ])(?P<name>" + _NAME + r"(?:[ ]" + _NAME + r"){0,2})",
}
_FINDER = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in _PATTERNS.items()))
# What every entity holds. Only white space beside a secret's sign may go on over the end of a line.
_TRIGGER = re.compile(r"[\d@]|[=:]\s{0,3}|AKIA|ASIA|(?:" + "|".join(sorted(_TITLES, key=len, reverse=True)) + r")[. ]")

# The first and last letters that stand for a script in surrogates.
_LETTERS = [("a", "z"), ("а", "я"), ("α", "ρ"), ("א", "ת"), ("ا", "غ"), ("अ", "ह"), ("ぁ", "ん"), ("ァ", "ン"), ("가", "힣"), ("一", "龥")]
_SYLLABLES = {
    "latin": ("b c d f g h j k l m n p r s t v w z br cl dr fr gr kl st tr", "a e i o u ai ei ou", "a", "n s r l t k"),
    "cyrillic": ("б в г д ж з к л м н п р с т ф х бр вл др кр ст тр", "а е и о у я", "а", "н в р л к й"),
    "greek": ("β γ δ ζ θ κ λ μ ν π ρ σ τ φ χ ψ", "α ε η ι ο υ ω", "α", "ς ν"),
}


def luhn(digits: str) -> int:
    """The check sum of a card number; 0 for a valid one."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def iban_rest(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def _script(word: str) -> str:
    name = unicodedata.name(word[0], "").split(" ")[0].lower()
    return name if name in _SYLLABLES else "other"


def _lines(text: str) -> Iterator[tuple[int, int]]:
    """Runs of whole lines that may hold an entity; no entity goes on over the end of a run."""
    start = end = -1
    for m in _TRIGGER.finditer(text):
        if m.end() <= end:
            continue
        low = m.start()
        if text[low] in "=:":
            while low > max(0, m.start() - 3) and text[low - 1].isspace():
                low -= 1
        low, high = text.rfind("\n", 0, low) + 1, text.find("\n", m.end())
        if low > end:
            if end >= 0:
                yield start, end
            start = low
        end = len(text) if high < 0 else high
    if end >= 0:
        yield start, end


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, normal form) of each entity, in order and apart from each other."""
    out, surnames = [], {}
    for m in (m for start, end in _lines(text) for m in _FINDER.finditer(text, start, end)):
        kind, value, start = m.lastgroup, m[0], m.start()
        if kind in ("value", "title", "name"):
            kind = "secret" if m["secret"] else "person"
        if kind == "secret":
            start, value = m.start("value"), m["value"]
            if value.isalpha():  # an ordinary word after "token:"
                continue
        digits = re.sub(r"\D", "", value)
        if kind == "email":
            out.append((start, m.end(), kind, value.lower()))
        elif kind == "ip":
            if all(int(p) < 256 for p in value.split(".")):
                out.append((start, m.end(), kind, value))
        elif kind == "card":
            if luhn(digits) == 0 or len(digits) == 16:
                out.append((start, m.end(), kind, digits))
        elif kind in ("phone", "ssn"):
            if len(digits) >= 9:
                out.append((start, m.end(), kind, ("+" if value[0] == "+" else "") + digits))
        elif kind == "iban":
            plain = value.replace(" ", "")
            if iban_rest(plain) == 1:
                out.append((start, m.end(), kind, plain))
        elif kind == "person":
            gender = "m" if m["title"] in MALE else "f" if m["title"] in FEMALE else "n"
            at, words = m.start("name"), m["name"].split(" ")
            for i, word in enumerate(words):
                last = i == len(words) - 1
                role = f"given-{gender}" if not last else "surname-f" if word.lower()[-1] in "ая" else "surname"
                out.append((at, at + len(word), role, word.lower()))
                if last:
                    surnames[word] = role
                at += len(word) + 1
        else:
            out.append((start, m.start() + len(m[0]) if kind == "key" else m.end("value"), kind, value))
    if surnames:  # the same surname elsewhere in the text, without a title
        again = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(surnames, key=len, reverse=True))) + r")(?!\w)")
        taken = [(a, b) for a, b, _, _ in out]
        for m in again.finditer(text):
            if not any(a < m.end() and m.start() < b for a, b in taken):
                out.append((m.start(), m.end(), surnames[m[0]], m[0].lower()))
    return sorted(out)


class Draw:
    """Numbers that follow from the key, the entity and the attempt."""

    def __init__(self, secret: bytes, kind: str, value: str, attempt: int):
        self.seed = hmac.new(secret, f"{kind}\0{value}\0{attempt}".encode(), hashlib.sha256).digest()
        self.state, self.block = int.from_bytes(self.seed, "big"), 0

    def below(self, n: int) -> int:
        if self.state < 1 << 64:
            self.block += 1
            self.state = int.from_bytes(hashlib.sha256(self.seed + self.block.to_bytes(4, "big")).digest(), "big")
        self.state, out = divmod(self.state, n)
        return out


def _shaped(value: str, draw: Draw, hexadecimal: bool = False) -> str:
    """Each letter and digit drawn anew within its script and case; hexadecimal stays so if asked."""
    if hexadecimal and re.fullmatch(r"[0-9a-f]*[0-9][0-9a-f]*", value) and len(value) >= 8:
        return "".join("0123456789abcdef"[draw.below(16)] for _ in value)
    out = []
    for c in value:
        if c.isdigit():
            out.append(str(draw.below(10)))
        elif c.isalpha():
            base = unicodedata.normalize("NFD", c.lower())[0]
            low, high = next(((a, b) for a, b in _LETTERS if a <= base <= b), ("a", "z"))
            new = chr(ord(low) + draw.below(ord(high) - ord(low) + 1))
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def _grown(value: str, attempt: int) -> str:
    """The shape of ``value``, longer from the fourth attempt on: short shapes can have too few surrogates."""
    return value + value[-1:] * (attempt // 4)


def _name(value: str, kind: str, attempt: int, draw: Draw) -> str:
    script = _script(value)
    if script not in _SYLLABLES:
        return _shaped(_grown(value, attempt), draw)
    heads, vowels, female, male = (x.split() for x in _SYLLABLES[script])
    word = "".join(heads[draw.below(len(heads))] + vowels[draw.below(len(vowels))] for _ in range(2 + attempt // 2))
    word += heads[draw.below(len(heads) // 2)]
    if kind in ("given-f", "surname-f"):  # in Cyrillic a family name has a gender too
        return word + female[draw.below(len(female))]
    return word + vowels[draw.below(len(vowels))] + male[draw.below(len(male))]


def surrogate(secret: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The normal form of an entity's surrogate; for an email the local part only."""
    draw = Draw(secret, kind, value, attempt)
    if kind == "email":
        return _shaped(_grown(value.partition("@")[0], attempt), draw)
    if kind == "domain":
        *parts, last = value.split(".")
        return ".".join([*(_shaped(p, draw) for p in parts[:-1]), *(_shaped(_grown(p, attempt), draw) for p in parts[-1:]), last])
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "card":
        body = value[0] + "".join(str(draw.below(10)) for _ in value[2:])
        check = next(c for c in "0123456789" if (luhn(body + c) == 0) == (luhn(value) == 0))
        return body + check
    if kind in ("phone", "ssn"):
        plus, digits = value[:1] == "+", value.lstrip("+")
        kept = digits[:max(0, len(digits) - 10)] if plus else ""
        rest = "".join(str(draw.below(10)) for _ in digits[len(kept) + 1:])
        return "+" * plus + kept + str(2 + draw.below(8)) + rest
    if kind == "iban":
        body = value[:2] + "00" + _shaped(value[4:], draw)
        return body[:2] + f"{98 - iban_rest(body):02d}" + body[4:]
    if kind == "key":
        return value[:4] + _shaped(_grown(value[4:], attempt), draw)
    if kind == "secret":
        return _shaped(_grown(value, attempt), draw, hexadecimal=True)
    return _name(value, kind, attempt, draw)


def dressed(found: str, kind: str, new: str) -> str:
    """A surrogate's normal form in the format of the text found."""
    if kind in ("card", "phone", "ssn", "iban"):
        fill = iter(new.lstrip("+"))
        return "".join(next(fill) if c.isalnum() else c for c in found)
    if kind == "email":
        return new.upper() if found.isupper() else new
    if kind.startswith(("surname", "given")):
        return new.upper() if found.isupper() and len(found) > 1 else new[:1].upper() + new[1:]
    return new


Attempts = dict[tuple[str, str], int]


def _new(secret: bytes, kind: str, value: str, attempts: Attempts) -> str:
    new = surrogate(secret, kind, value, attempts.get((kind, value), 0))
    if kind == "email":
        domain = value.partition("@")[2]
        new += "@" + surrogate(secret, "domain", domain, attempts.get(("domain", domain), 0))
    return new


def replaced(text: str, secret: bytes, attempts: Attempts) -> tuple[str, list[tuple[str, str, str]]]:
    """The text with surrogates, and (kind, found, surrogate) of each entity."""
    out, start, entities = [], 0, []
    for a, b, kind, value in find(text):
        if a < start:
            continue
        new = dressed(text[a:b], kind, _new(secret, kind, value, attempts))
        out += [text[start:a], new]
        entities.append((kind, text[a:b], new))
        start = b
    return "".join([*out, text[start:]]), entities


def _entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tid, kind, value), each once per text; the domain of an email is an entity too."""
    for batch in batches:
        tids, kinds, values = [], [], []
        for tid, text in zip(batch["tid"].to_pylist(), batch["text"]):
            own = {(kind, value) for _, _, kind, value in find(text.as_py() or "")}
            own |= {("domain", value.partition("@")[2]) for kind, value in own if kind == "email"}
            for kind, value in sorted(own):
                tids.append(tid)
                kinds.append(kind)
                values.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(tids, pa.int64()), pa.array(kinds, pa.string()), pa.array(values, pa.string())], ["tid", "kind", "value"])


def _draw(secret: bytes, make: Callable) -> Callable:
    """The surrogate of each (kind, value, attempt), as it is compared: emails with the domain found."""

    def run(batches):
        for batch in batches:
            new = []
            for kind, value, attempt in zip(*(batch[c].to_pylist() for c in ("kind", "value", "attempt"))):
                word = make(secret, kind, value, attempt)
                new.append(f"{word}@{value.partition('@')[2]}" if kind == "email" else word)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("kind", "value", "attempt")), pa.array(new, pa.string())], ["kind", "value", "attempt", "new"])

    return run


def settle(entities: DataFrame, secret: bytes, make: Callable = surrogate) -> DataFrame:
    """(kind, value, attempt): attempts at which all surrogates of a kind differ and none is an entity.

    ``entities`` holds each (kind, value) once. Given and family names are each kinds of their own.
    """
    schema = "kind string, value string, attempt int, new string"
    table = materialize(entities.select("kind", "value", F.lit(0).alias("attempt")).mapInArrow(released(_draw(secret, make)), schema), "surrogates")
    while True:
        twice = materialize(
            table.groupBy("kind", "new").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("first")).filter("n > 1").select("kind", "new", "first"), "clashes")
        real = table.select("kind", F.col("value").alias("new"))
        losers = materialize(
            table.join(twice, ["kind", "new"]).filter("value <> first").select("kind", "value")
            .unionByName(table.join(real, ["kind", "new"], "left_semi").select("kind", "value")).distinct(), "losers")
        if losers.isEmpty():
            return table.select("kind", "value", "attempt")
        again = table.join(losers, ["kind", "value"], "left_semi").select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        table = materialize(
            table.join(losers, ["kind", "value"], "left_anti").unionByName(again.mapInArrow(released(_draw(secret, make)), schema)), "surrogates")


_FOUND = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("kind", "found", "surrogate")]))


def _apply(secret: bytes, sent: Attempts, text_col: str, names: list[str], own_col: str | None = None) -> Callable:
    def run(batches):
        for batch in batches:
            texts, found = [], []
            more = batch[own_col].to_pylist() if own_col else [None] * batch.num_rows
            for value, own in zip(batch[text_col], more):
                text = value.as_py()
                attempts = sent if own is None else {(x["kind"], x["value"]): x["attempt"] for x in own}
                text, entities = replaced(text, secret, attempts) if text else (text, [])
                texts.append(text)
                found.append([{"kind": k, "found": f, "surrogate": n} for k, f, n in entities])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("found", pa.string()), ("surrogate", pa.string())]))
            columns = [pa.array(texts, pa.string()) if n == text_col else batch[n] for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], [*names, "entities"])

    return run


def with_surrogates(docs: DataFrame, secret: str | bytes, text_col: str = "text", sent: int = SENT) -> DataFrame:
    """``docs`` with surrogates in the text, and ``entities``: (kind, found, surrogate) in order.

    Found are emails, secrets after their names, cloud keys, account numbers, IPv4 addresses, social
    security, phone and card numbers, and names after a title, surnames also elsewhere in such a text.
    The format of numbers, check sums, script, case and grammatical gender stay. Distinct
    entities of a kind keep distinct surrogates over the whole table, and equal ones share theirs, in
    repeated rows too. A null text stays null and an empty one empty, with no entities. Other columns are
    unchanged; one called ``entities`` is replaced. An empty table gives no rows.
    """
    secret = secret.encode() if isinstance(secret, str) else secret
    if "entities" in docs.columns:
        docs = docs.drop("entities")
    names = docs.columns
    seen = docs.select(F.xxhash64(text_col).alias("tid"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    entities = seen.mapInArrow(released(_entities), "tid long, kind string, value string")
    later = materialize(settle(entities.select("kind", "value").distinct(), secret).filter("attempt > 0"), "attempts")
    schema = T.StructType([*docs.schema.fields, T.StructField("entities", _FOUND)])
    if later.count() <= sent:
        attempts = {(r["kind"], r["value"]): r["attempt"] for r in later.collect()}
        return docs.mapInArrow(released(_apply(secret, attempts, text_col, names)), schema)
    own_col, own_tid = fresh(names, "_attempts", "_tid")
    by_text = materialize(
        entities.distinct().join(later, ["kind", "value"]).groupBy(F.col("tid").alias(own_tid)).agg(
            F.collect_list(F.struct("kind", "value", "attempt")).alias(own_col)), "by-text")
    marked = docs.withColumn(own_tid, F.xxhash64(text_col)).join(by_text.hint("shuffle_hash"), own_tid, "left").select(*names, own_col)
    return marked.mapInArrow(released(_apply(secret, {}, text_col, names, own_col)), schema)
