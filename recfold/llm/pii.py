"""Personal data replaced by keyed, type-consistent surrogates.

Detected: e-mail addresses, telephone numbers, payment cards, IBANs, IPv4
addresses, US social security numbers, access keys, secrets after a key word,
and person names after a form of address or a known first name.

A surrogate keeps what makes the value what it is: length, separators, case,
script, vowels and consonants; the country code of a number; the brand digit
and the check-digit status of a card; country and valid check digits of an
IBAN; the kind of an address range; the gender of a first name. It is a keyed
permutation of the values of one format (a Feistel network with cycle
walking), so within a format different values stay different, and the same
value, in whatever layout or case, gets the same surrogate everywhere.

Collision check, over the distinct values of the whole corpus: a surrogate may
not be another value of the corpus nor the surrogate of another one. Values
that clash move on to the next permutation until none does, in rounds of joins
over written tables. A value that has clashed LONGER times leaves its format,
which is then nearly used up: names, e-mail addresses, secrets and numbers get
longer, a private IPv4 address takes the next larger private range, any other
address an IPv6 address of the documentation range. The moved values travel to
the tasks in a broadcast of at most ``MOVED`` of them, and texts are not shuffled
(one scan gathers values, one replaces them); more moved values are joined to
the digests of the texts that hold them, and these to the texts.

Names: a first name from the lists below becomes another one of its list
(gender and script); other first names keep their last letter; a surname that
was found with its form of address or first name is also replaced where it
stands alone in the same text.

Defined results: a null text stays null, an empty one empty; repeated rows are
answered row by row; other columns pass through; ``n_chars`` is counted anew
where there is such a column; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recfold.llm.common import drop_columns, join_counted, materialize, share
from recfold.session import discard

KEY = b"surrogates-1"
MOVED = 1_000_000
ROUNDS = 6
LONGER = 8

# --- fixed values: first names by script and gender, forms of address ---
FIRST_NAMES = {
    ("latin", "f"): "Anna Maria Laura Julia Sarah Emma Sophie Claire Elena Carmen Lucia Paula Martina Katrin Sabine Ursula "
                    "Monika Camille Juliette Isabelle Jennifer Jessica Elizabeth Margaret Susan Linda Patricia Barbara",
    ("latin", "m"): "John James Robert Michael William David Richard Thomas Charles Daniel Matthew Anthony Steven Hans "
                    "Stefan Andreas Jürgen Wolfgang Pierre François Nicolas Antoine Carlos Javier Miguel Pablo Diego Jorge",
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия",
    ("cyrillic", "m"): "Иван Сергей Алексей Дмитрий Андрей Николай Михаил Владимир Павел Виктор",
    ("greek", "f"): "Μαρία Ελένη Αικατερίνη Βασιλική Σοφία Άννα",
    ("greek", "m"): "Γιώργος Δημήτρης Κώστας Νίκος Γιάννης Παναγιώτης",
}
ADDRESS = {
    "m": ["Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "господин", "г-н", "Господин", "κύριος", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "госпожа", "г-жа", "Госпожа", "κυρία", "Κυρία"],
    "": ["Dr", "Prof"],
}
SECRET_WORDS = ["token", "password", "passwd", "pwd", "secret", "api_key", "api-key", "apikey", "access_key"]
CLASSES = ["0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòùâêîôûäëïöü", "ñç", "аеиоуыэюяё", "бвгджзйклмнпрстфхцчшщ",
           "αειουηω", "βγδζθκλμνξπρστφχψ", "άέίόύήώ"]
#: The larger private ranges that a used-up one moves on to: first byte and free bits.
WIDER = {"192.168": [(172, 20), (10, 24)], "172.16": [(10, 24)]}
# --- end of fixed values ---

_NAMES = {x: (script, g) for (script, g), names in FIRST_NAMES.items() for x in names.split()}
_LISTS = {k: v.split() for k, v in FIRST_NAMES.items()}
_GENDER = {w: g for g, ws in ADDRESS.items() for w in ws}
_CLASS = {c: i for i, cs in enumerate(CLASSES) for c in cs}
_UP = "A-ZÀ-ÖØ-ÞА-ЯЁΑ-ΩΆΈΉΊΌΎΏ"
_LOW = "a-zß-öø-ÿа-яёα-ωάέήίόύώς"
_WORD = f"[{_UP}][{_LOW}]+(?:-[{_UP}][{_LOW}]+)?"
_FORMS = "|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True))
_FIRSTS = "|".join(sorted(_NAMES, key=len, reverse=True))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"

_FIND = re.compile("|".join([
    r"(?P<email>(?<![\w.+-])[A-Za-z0-9][\w.+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})",
    rf"(?P<secret>(?i:\b(?:{'|'.join(SECRET_WORDS)}))\s*[=:]\s*[\"']?(?P<value>[A-Za-z0-9_+/.-]{{6,}}))",
    r"(?P<key>\b(?:AKIA|ASIA)[A-Z0-9]{16}\b)",
    r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)",
    rf"(?P<ip>(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\d]|\.\d))",
    r"(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\d)"
    r"|(?<!\d)\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d.-]))",
    r"(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))",
    r"(?P<card>(?<![\d.])[3-6](?:[ -]?\d){12,18}(?!\d))",
    rf"(?P<person>(?<!\w)(?:(?P<form>{_FORMS})(?!\w)\.?\s+(?P<names>{_WORD}(?:[ ]{_WORD}){{0,2}})|(?P<known>{_FIRSTS})[ ](?P<last>{_WORD})))",
]))


def _ranges(chars: list[int]) -> str:
    """A character class of code points, for both regex engines."""
    out, first = "", None
    for a, b in zip(chars, [*chars[1:], -1]):
        first = a if first is None else first
        if b != a + 1:
            out, first = out + (chr(first) if first == a else f"{chr(first)}-{chr(a)}"), None
    return f"[{out}]"


def _any_case(word: str) -> str:
    """What Python's (?i) takes for the word; it folds more letters than Arrow's engine."""
    return "".join(f"[{c.upper()}{c.lower()}{''.join(x for x in 'İıſK' if re.match(c, x, re.I))}]" if c.isalpha() else re.escape(c) for c in word)


#: What a text must hold to be looked at closely, for a linear-time scan: every match of _FIND
#: holds a match of this one (digits are those of Python's \d, of any script).
_DIGIT = _ranges([c for c in range(0x110000) if chr(c).isdecimal()])
_MAYBE = "|".join([rf"{_DIGIT}[ .-]?{_DIGIT}", "@", "AKIA|ASIA", *map(_any_case, SECRET_WORDS), *map(re.escape, [*_GENDER, *_NAMES])])


# --------------------------------------------------------------------------
# permutations
# --------------------------------------------------------------------------

def permute(x: int, size: int, key: bytes, tweak: str) -> int:
    """Keyed permutation of 0..size-1."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    name = tweak.encode()
    while True:
        a, b = x >> half, x & mask
        for r in range(ROUNDS):
            d = hashlib.blake2b(b"%d|" % r + name + b"|" + b.to_bytes((half + 7) // 8, "big"), key=key,
                                digest_size=min(64, (half + 7) // 8 + 8)).digest()
            a, b = b, a ^ (int.from_bytes(d, "big") & mask)
        x = (a << half) | b
        if x < size:
            return x


def recode(text: str, key: bytes, tweak: str, classes: list[str] | None = None) -> str:
    """Permute a lower-case text among those of its format: each character
    stays in its class, others stay as they are."""
    place = _CLASS if classes is None else {c: i for i, cs in enumerate(classes) for c in cs}
    classes = CLASSES if classes is None else classes
    kind = [place.get(c) for c in text]
    size = number = 1
    number = 0
    for c, k in zip(text, kind):
        if k is not None:
            number = number * len(classes[k]) + classes[k].index(c)
            size *= len(classes[k])
    if size == 1:
        return text
    pattern = ",".join(c if k is None else f"#{k}" for c, k in zip(text, kind))
    number = permute(number, size, key, f"{tweak}/{pattern}")
    out = []
    for c, k in zip(reversed(text), reversed(kind)):
        if k is None:
            out.append(c)
        else:
            number, d = divmod(number, len(classes[k]))
            out.append(classes[k][d])
    return "".join(reversed(out))


def _luhn(digits: str) -> bool:
    total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def _iban_ok(s: str) -> bool:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _range(ip: str) -> str:
    a, b = map(int, ip.split(".")[:2])
    if a in (10, 127):
        return f"{a}"
    if (a, b) == (192, 168):
        return "192.168"
    if a == 172 and 16 <= b < 32:
        return "172.16"
    return "reserved" if a == 0 or a >= 224 else "public"


def _draw(kind: str, value: str, key: bytes, attempt: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{kind}/{value}/{attempt}".encode(), key=key, digest_size=16).digest(), "big")


@lru_cache(maxsize=200_000)
def surrogate(kind: str, value: str, key: bytes, attempt: int = 0) -> str:
    """The surrogate of a canonical value. Where the values of a short format
    have clashed LONGER times, the surrogate leaves the format."""
    if attempt >= LONGER and kind in ("phone", "ssn", "card"):
        return surrogate(kind, value, key, 0) + str(_draw(kind, value, key, attempt)).zfill(40)[-(attempt - LONGER + 1):]
    if attempt >= LONGER and kind == "ip":
        wider = WIDER.get(_range(value), [])
        drawn = _draw(kind, value, key, attempt)
        if attempt - LONGER < len(wider):
            first, free = wider[attempt - LONGER]
            return ".".join(map(str, (first << 24 | (16 << 16 if first == 172 else 0) | drawn % (1 << free)).to_bytes(4, "big")))
        return "2001:db8:" + ":".join(f"{drawn >> 16 * i & 0xFFFF:x}" for i in range(6))
    if attempt >= LONGER and kind in ("email", "secret", "last") or attempt >= LONGER and kind.startswith("first-"):
        more = recode("ba" * (attempt - LONGER + 1), hashlib.blake2b(f"{kind}/{value}".encode(), key=key).digest(), "longer")
        out = surrogate(kind, value, key, 0)
        at = out.index("@") if kind == "email" else len(out)
        return out[:at] + more + out[at:]
    tweak = f"{kind}/{attempt}"
    if kind in ("phone", "ssn", "digits"):
        return recode(value, key, tweak)
    if kind == "card":
        valid = _luhn(value)
        out = value
        while True:  # walks among cards of the same brand digit and check-digit status
            out = value[0] + recode(out[1:], key, tweak + value[0])
            if _luhn(out) == valid:
                return out
    if kind == "ip":
        zone = _range(value)
        x = int.from_bytes(bytes(map(int, value.split("."))), "big")
        keep = {"10": 24, "127": 24, "192.168": 16, "172.16": 20}.get(zone, 32)
        while True:
            x = (x >> keep << keep) | permute(x & ((1 << keep) - 1), 1 << keep, key, f"{tweak}/{zone}")
            out = ".".join(map(str, x.to_bytes(4, "big")))
            if _range(out) == zone:
                return out
    if kind == "iban":
        body = recode(value[4:].lower(), key, tweak + value[:2], ["0123456789", "abcdefghijklmnopqrstuvwxyz"]).upper()
        check = 98 - int("".join(str(int(c, 36)) for c in body + value[:2] + "00")) % 97
        return f"{value[:2]}{check:02d}{body}"
    if kind == "key":
        return value[:4] + recode(value[4:], key, tweak, ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"])
    if kind == "secret":
        hexadecimal = set(value) <= set("0123456789abcdef")
        return recode(value, key, tweak, ["0123456789abcdef"] if hexadecimal else ["abcdefghijklmnopqrstuvwxyz", "0123456789"])
    if kind == "email":
        local, _, domain = value.partition("@")
        names, _, top = domain.rpartition(".")
        return f"{recode(local, key, tweak)}@{recode(names, key, 'domain/0')}.{top}"
    if kind.startswith("first-"):
        script, gender = kind.split("-")[1:]
        names = [x.lower() for x in _LISTS.get((script, gender), [])]
        if value in names:
            return names[permute(names.index(value), len(names), key, tweak)]
        return recode(value[:-1], key, tweak) + value[-1]
    return recode(value, key, tweak)  # surnames


def script_of(word: str) -> str:
    c = word[0].lower()
    return "cyrillic" if "а" <= c <= "я" or c == "ё" else "greek" if "\u0370" <= c <= "\u03ff" else "latin"


# --------------------------------------------------------------------------
# detection and replacement
# --------------------------------------------------------------------------

def _names(text: str, m: re.Match):
    """(from, to, kind, canonical) of the names of a person match."""
    if m["known"]:
        script, gender = _NAMES[m["known"]]
        parts, spans = [m["known"], m["last"]], [m.span("known"), m.span("last")]
    else:
        gender, at = _GENDER[m["form"]], m.start("names")
        parts, spans = [], []
        for w in m["names"].split(" "):
            parts.append(w)
            spans.append((at, at + len(w)))
            at += len(w) + 1
        script = script_of(parts[0])
    out = []
    for i, (w, (a, b)) in enumerate(zip(parts, spans)):
        if i < len(parts) - 1:
            listed = _NAMES.get(w)
            out.append((a, b, "first-%s-%s" % (listed or (script, gender)), w.lower()))
        else:
            out.append((a, b, "last", w.lower()))
    return out


def _digits(raw: str) -> str:
    """The digits of a value, whatever their script, as 0-9."""
    return "".join(str(int(c)) for c in raw if c.isdecimal())


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Entities of a text in order: from, to, kind, canonical value."""
    out = []
    for m in _FIND.finditer(text):
        kind, (a, b) = m.lastgroup, m.span()
        kind = next(k for k in ("email", "secret", "key", "iban", "ip", "phone", "ssn", "card", "person") if m[k])
        raw = m[0]
        if kind == "email":
            out.append((a, b, kind, raw.lower()))
        elif kind == "secret":
            value = m["value"].rstrip(".")
            if sum(c.isdigit() for c in value) >= 2:  # a word after the key word is not a secret
                out.append((*(m.start("value"), m.start("value") + len(value)), kind, value.lower()))
        elif kind == "key":
            out.append((a, b, kind, raw))
        elif kind == "iban":
            value = "".join(str(int(c)) if c.isdecimal() else c for c in raw if c != " ")
            if 15 <= len(value) <= 34 and _iban_ok(value):
                out.append((a, b, kind, value))
        elif kind == "ip":
            out.append((a, b, kind, ".".join(str(int(x)) for x in raw.split("."))))
        elif kind == "phone":
            code = re.match(r"\+\d{1,3}(?=[ .(-])", raw)
            start = code.end() if code else 0
            digits = _digits(raw[start:])
            if 7 <= len(digits) <= 14:
                out.append((a + start, b, kind, digits))
        elif kind == "ssn":
            out.append((a, b, kind, _digits(raw)))
        elif kind == "card":
            digits = _digits(raw)
            if 13 <= len(digits) <= 19 and (_luhn(digits) or len(digits) == len(raw) == 16):
                out.append((a, b, kind, digits))
        else:
            out.extend(_names(text, m))
    surnames = {(text[a:b], v) for a, b, k, v in out if k == "last" and b - a >= 4}
    if surnames:  # the same surname elsewhere in the text
        taken = {a for a, _, _, _ in out}
        again = re.compile(r"(?<!\w)(?:" + "|".join(re.escape(w) for w, _ in sorted(surnames)) + r")(?!\w)")
        covered = [(a, b) for a, b, _, _ in out]
        for m in again.finditer(text):
            if m.start() not in taken and not any(a <= m.start() < b for a, b in covered):
                out.append((*m.span(), "last", m[0].lower()))
        out.sort()
    return out


def _lay_out(shape: str, kind: str, value: str) -> str:
    """Write a canonical surrogate in the layout and case of ``shape``."""
    if kind == "ip":
        return value
    source = iter(value)
    if kind in ("phone", "ssn", "card"):
        return "".join(chr(ord(c) - int(c) + int(next(source))) if c.isdecimal() else c for c in shape) + "".join(source)
    if kind == "iban":
        return "".join(c if c == " " else next(source) for c in shape)
    if kind in ("first", "last") or kind.startswith("first-"):
        if shape.isupper():
            return value.upper()
        return "-".join(x[:1].upper() + x[1:] for x in value.split("-"))
    if kind == "secret" and shape.isupper():
        return value.upper()
    out = []
    for c, v in zip(shape, value):
        out.append(v.upper() if c.isupper() and len(v.upper()) == 1 else v)
    return "".join(out) + value[len(shape):]


def replace(text: str, key: bytes, moved: dict[tuple[str, str], int]) -> tuple[str, int]:
    """The text with surrogates, and the number of entities."""
    found = find(text)
    if not found:
        return text, 0
    out, at = [], 0
    for a, b, kind, value in found:
        if a < at:
            continue
        out += [text[at:a], _lay_out(text[a:b], kind, surrogate(kind, value, key, moved.get((kind, value), 0)))]
        at = b
    return "".join([*out, text[at:]]), len(found)


def _worth(col: pa.Array) -> list[int]:
    hit = pc.fill_null(pc.match_substring_regex(col, _MAYBE), False)
    return pc.indices_nonzero(hit).to_pylist()


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct (kind, value) of the corpus; each task sends a value once per batch."""

    def gather(batches):
        for b in batches:
            col = b.column(0)
            seen = sorted({(k, v) for i in _worth(col) for _, _, k, v in find(col[i].as_py())})
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in seen], pa.string()), pa.array([v for _, v in seen], pa.string())],
                                             names=["kind", "value"])

    return docs.select(text_col).mapInArrow(gather, "kind string, value string").distinct()


def settled(values: DataFrame, key: bytes = KEY) -> DataFrame:
    """Written table (kind, value, attempt): permutation numbers of the values that had to move on."""

    def give(batches):
        for b in batches:
            given = [surrogate(k, v, key, i) for k, v, i in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(given, pa.string())], names=["kind", "value", "attempt", "given"])

    # first names of the lists are meant to be exchanged among themselves
    real = values.filter(~F.col("kind").startswith("first-")).select("kind", F.col("value").alias("given"), F.lit(True).alias("real"))
    moved = materialize(values.limit(0).select("kind", "value", F.lit(0).alias("attempt")), "moved")
    while True:
        now = values.join(moved, ["kind", "value"], "left").select("kind", "value", F.coalesce("attempt", F.lit(0)).alias("attempt"))
        given = now.mapInArrow(give, "kind string, value string, attempt int, given string")
        keep = F.min(F.struct("attempt", "value")).alias("keep")
        uses = given.groupBy("kind", "given").agg(keep, F.count("*").alias("n"))
        clash = (given.join(uses, ["kind", "given"]).join(real, ["kind", "given"], "left")
                 .filter("real or (n > 1 and value != keep.value)").select("kind", "value", "attempt"))
        clash = materialize(clash, "clash")
        if clash.isEmpty():
            return moved
        before = moved
        moved = materialize(moved.join(clash, ["kind", "value"], "left_anti")
                            .unionByName(clash.withColumn("attempt", F.col("attempt") + 1)), "moved")
        discard(before)
        discard(clash)


def settle(values: DataFrame, key: bytes = KEY, bound: int = MOVED) -> dict[tuple[str, str], int]:
    """``settled`` as a mapping of at most ``bound`` values."""
    rows = settled(values, key).limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"more than {bound} surrogates have moved")
    return {(r["kind"], r["value"]): r["attempt"] for r in rows}


def _moved_by_text(docs: DataFrame, moved: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with a column ``_moved``: the moved values of the text, as (kind, value, attempt). A text is known by its
    digest and read once for all its copies; texts that most rows share are joined by broadcast."""

    def gather(batches):
        for b in batches:
            col = b.column(1)
            rows = [(i, k, v) for i in _worth(col) for k, v in {(k, v) for _, _, k, v in find(col[i].as_py())}]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([i for i, _, _ in rows], pa.int64())), *(
                pa.array([r[j] for r in rows], pa.string()) for j in (1, 2))], names=["_digest", "kind", "value"])

    keyed = docs.withColumn("_digest", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    held = keyed.select("_digest", text_col).mapInArrow(gather, "_digest string, kind string, value string")
    counts = keyed.groupBy("_digest").agg(F.count("*").alias("_n"))
    lists = (held.distinct().join(moved, ["kind", "value"]).groupBy("_digest")
             .agg(F.collect_list(F.struct("kind", "value", "attempt")).alias("_moved")))
    lists = materialize(counts.join(lists, "_digest", "left"), "moved-by-text")
    return join_counted(keyed, lists, ["_digest"], "_n").drop("_digest")


def replace_all(docs: DataFrame, key: bytes = KEY, text_col: str = "text", count: str | None = None, bound: int = MOVED) -> DataFrame:
    """``docs`` with surrogates in the text; ``count`` adds the number of entities."""
    values = materialize(entities(docs, text_col), "entities")
    moved = settled(values, key)
    base = drop_columns(docs, [count] if count else [])
    schema = T.StructType([*base.schema, *([T.StructField(count, T.LongType())] if count else [])])
    few = moved.limit(bound + 1).count() <= bound
    shared = share(docs.sparkSession, {(r["kind"], r["value"]): r["attempt"] for r in moved.collect()}) if few else None
    rows = base if few else _moved_by_text(base, moved, text_col)

    def work(batches):
        for b in batches:
            own = None if few else b.column(b.num_columns - 1)
            columns = b.columns[:len(b.columns) - (not few)]
            at = b.schema.names.index(text_col)
            col = b.column(at)
            n = [0] * len(col)
            new = {}
            for i in _worth(col):
                away = shared.value if few else {(m["kind"], m["value"]): m["attempt"] for m in own[i].as_py() or ()}
                new[i], n[i] = replace(col[i].as_py(), key, away)
            if any(n):
                col = pa.array([new.get(i, x) for i, x in enumerate(col.to_pylist())], col.type)
            cols = [col if j == at else c for j, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(n, pa.int64())] if count else []), names=schema.names)

    out = rows.mapInArrow(work, schema)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.when(F.col(text_col).isNull(), F.col("n_chars"))
                             .otherwise(F.length(text_col).cast(base.schema["n_chars"].dataType)))
    return out
