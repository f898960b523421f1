"""PII surrogates: entities get keyed replacements of their type, gender, script and format.

An entity is a kind and a canonical form, so that "+1 (499) 555-6503" and "14995556503" are one. Its surrogate
is drawn from HMAC(key, kind, form, attempt). Surrogates that meet one another, or an entity of the corpus, are
drawn again until none does: different entities stay different, and equal ones equal, over all documents.
Attempts other than 0 are rare; only these are looked up when texts are rewritten.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches

#: Attempts that are kept in each worker's memory; more of them travel with their documents.
HELD_ATTEMPTS = 50_000
MOST_ATTEMPTS = 60
#: Attempts from which a surrogate keeps less of its entity's format, as the pool of that format seems to be full.
LOOSE = 20

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}\b")
LOCAL = re.compile(r"[\w.%+-]")
NUMBERS = re.compile(
    r"(?<![\w.])(?:(?P<ipv4>(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3})(?![\w]|\.\d)"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    r"|(?P<card>\d{4}([ -]?)\d{4}\4\d{4}\4\d{1,7}|3\d{3}([ -]?)\d{6}\5\d{5})(?![\w-])"
    r"|(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)"
    r"|(?P<phone>(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}|\d{3}[ .-]\d{3}[ .-]\d{4})(?![\w-]))"
)
# Eight groups of hexadecimal digits, or fewer around one "::"; what ipaddress can't read is no address.
IPV6 = re.compile(r"(?<![\w:.])(?=[0-9A-Fa-f:]*:[0-9A-Fa-f:]*:)[0-9A-Fa-f:]{3,39}(?![\w:]|\.\d)")
SECRET = re.compile(r"(?<![\w])(?=[0-9a-fA-F]*[a-fA-F])(?=[0-9a-fA-F]*\d)[0-9a-fA-F]{32,64}(?!\w)")
# Titles by gender, with the names behind them; a title's gender is that of the person.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Sir", "Signor", "господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "госпожа"],
}
GENDER = {t: g for g, titles in TITLES.items() for t in titles}
NAME = r"[^\W\d_a-zа-я](?:[^\W\d_]|['’](?=[^\W\d_]))+(?:-[^\W\d_]+)?"
PERSON = re.compile(r"\b(" + "|".join(sorted(GENDER, key=len, reverse=True)) + r")\.?[ ](?:[^\W\d_a-zа-я]\.[ ]?)*(" + NAME + r")(?:[ ](?:[^\W\d_a-zа-я]\.[ ]?)*(" + NAME + r"))?")
SYLLABLES = {
    "latin": (list("bdfgklmnprstv"), list("aeiou"), {"m": "n", "f": "a", "": "r"}),
    "cyrillic": (list("бвгдзклмнпрст"), list("аеиоу"), {"m": "н", "f": "а", "": "в"}),
    "greek": (list("βγδκλμνπρστ"), list("αειου"), {"m": "ς", "f": "α", "": "ς"}),
}


def script(word: str) -> str:
    c = ord(word[0])
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "latin"


def people(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, form) of the names behind a title, and of every other mention of these names in the text.

    Behind a title come a given and a family name, or the latter alone, with initials between; the title's gender is
    that of the given name, and of a family name in a script whose family names have one."""
    found, kinds = [], {}
    for m in PERSON.finditer(text):
        gender, names = GENDER[m[1]], [i for i in (2, 3) if m[i] and m[i][0].isupper()]
        for i in names:
            given, alphabet = i == 2 and len(names) == 2, script(m[i])
            kind = f"name.given.{gender}.{alphabet}" if given else f"name.family.{gender}.{alphabet}" if alphabet == "cyrillic" else f"name.family.{alphabet}"
            kind = kinds.setdefault(m[i], kind)
            found.append((m.start(i), m.end(i), kind, m[i].lower()))
    if kinds:
        again = re.compile(r"(?<![\w'’-])(?:" + "|".join(map(re.escape, sorted(kinds, key=len, reverse=True))) + r")(?![\w-]|['’]\w{2})")
        found += [(m.start(), m.end(), kinds[m[0]], m[0].lower()) for m in again.finditer(text)]
    return found


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, form) of the entities in a text, in order, none overlapping; of two that begin at one place the longer wins."""
    found = []
    for m in DOMAIN.finditer(text):
        low = m.start()
        while low > 0 and LOCAL.match(text[low - 1]):
            low -= 1
        low += len(text[low : m.start()]) - len(text[low : m.start()].lstrip("."))
        if low < m.start():
            found.append((low, m.end(), "email", text[low : m.end()].lower()))
    found += [(m.start(), m.end(), "secret", m[0].lower()) for m in SECRET.finditer(text)]
    for m in NUMBERS.finditer(text):
        kind = m.lastgroup if m.lastgroup else next(k for k, v in m.groupdict().items() if v)
        form = m[0] if kind == "ipv4" else re.sub(r"[^0-9A-Za-z]", "", m[0])
        found.append((m.start(), m.end(), kind, form))
    for m in IPV6.finditer(text):
        try:
            found.append((m.start(), m.end(), "ipv6", str(ipaddress.IPv6Address(m[0]))))
        except ValueError:
            continue
    found += people(text)
    found.sort(key=lambda e: (e[0], -e[1]))
    out, end = [], 0
    for e in found:
        if e[0] >= end:
            out.append(e)
            end = e[1]
    return out


class Stream:
    """Numbers below n from a keyed stream."""

    def __init__(self, key: bytes, *parts: str):
        seed = hmac.new(key, "\0".join(parts).encode(), hashlib.sha256).digest()
        self.value = int.from_bytes(hashlib.shake_256(seed).digest(96), "big")

    def below(self, n: int) -> int:
        self.value, r = divmod(self.value, n)
        return r

    def pick(self, of):
        return of[self.below(len(of))]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def draw(key: bytes, kind: str, form: str, attempt: int) -> str:
    """The canonical form of the surrogate."""
    s = Stream(key, kind, form, str(attempt))
    digits = lambda n: "".join(str(s.below(10)) for _ in range(n))
    if kind == "email":
        local, _, domain = form.partition("@")
        shape = lambda text: "".join(str(s.below(10)) if c.isdigit() else s.pick("aeiou") if c in "aeiou" else s.pick("bcdfghklmnprstvwz") if c.isalpha() else c for c in text)
        host, _, top = domain.rpartition(".")
        extra = "".join(s.pick("bdfglmnrst") + s.pick("aeiou") for _ in range((attempt + 3) // 4))
        return f"{shape(local)}{extra}@{shape(host)}.{top}"
    if kind == "ipv4":
        old = ipaddress.ip_address(".".join(str(int(p)) for p in form.split(".")))
        fixed = {10: 1, 127: 1, 192: 2, 172: 2, 169: 2}.get(int(old).to_bytes(4, "big")[0], 0) if old.is_private or old.is_link_local else 0
        head = form.split(".")[:fixed]
        if fixed == 2 and attempt >= LOOSE:  # a private range that is full: the largest one
            fixed, head = 1, ["10"]
        while True:
            new = ".".join([*head, *(str(s.below(254) + 1) for _ in range(4 - fixed))])
            if fixed or ipaddress.ip_address(new).is_global or s.value == 0:
                return new
    if kind == "ipv6":
        old = ipaddress.IPv6Address(form)
        head = old.exploded.split(":")[: 0 if old.is_global else 4]
        groups = [*(head or ["2001", f"{s.below(1 << 16):x}"]), *(f"{s.below(1 << 16):x}" for _ in range(8))][:8]
        return str(ipaddress.IPv6Address(":".join(groups)))
    if kind == "card":
        body = form[: 1 if attempt < LOOSE else 0]
        body += digits(len(form) - 1 - len(body))
        valid = [d for d in "0123456789" if luhn(body + d)]
        return body + (valid[0] if luhn(form) else s.pick([d for d in "0123456789" if d != valid[0]]))
    if kind == "iban":
        tail = "".join(str(s.below(10)) if c.isdigit() else s.pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c.isupper() else s.pick("abcdefghijklmnopqrstuvwxyz") for c in form[4:])
        return f"{form[:2]}{98 - mod97(form[:2] + '00' + tail):02d}{tail}"
    if kind == "ssn":
        return f"{s.below(665) + 1:03d}{s.below(99) + 1:02d}{s.below(9999) + 1:04d}"
    if kind == "phone":
        head = form[: max(0, len(form) - 10)] if attempt < LOOSE else ""
        return head + str(s.below(8) + 2) + digits(len(form) - len(head) - 1)
    if kind == "secret":
        return "".join(s.pick("0123456789abcdef") for _ in form)
    _, *gender, alphabet = kind.split(".")
    consonants, vowels, ends = SYLLABLES[alphabet]
    name = "".join(s.pick(consonants) + s.pick(vowels) for _ in range(2 + s.below(2) + attempt // 4))
    if gender[0] == "family" and len(gender) == 2:
        return name + {"m": "ов", "f": "ова"}[gender[1]]
    return name + (ends[gender[1]] if len(gender) == 2 else ends[""])


def render(surrogate: str, surface: str, kind: str) -> str:
    """The surrogate in the format of the text: separators of numbers, case of letters."""
    if kind in ("card", "iban", "ssn", "phone"):
        new = iter(surrogate)
        return "".join(next(new) if c.isalnum() else c for c in surface)
    if surface.isupper():
        return surrogate.upper()
    if kind.startswith("name"):
        return surrogate[0].upper() + surrogate[1:]
    return surrogate


def attempts(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, form, attempt) where it isn't 0, from distinct (kind, form).

    Each round draws, groups by surrogate and lets one of each group go: one that stays from earlier rounds,
    else the smallest form; none where an entity of the corpus has that form."""
    small_batches(found.sparkSession, 5000, "4m")

    def run(batches):
        for b in batches:
            rows = zip(*(c.to_pylist() for c in b.columns))
            drawn = [draw(key, kind, form, n) for kind, form, n in rows]
            yield pa.record_batch([*b.columns, pa.array(drawn, pa.string())], ["kind", "form", "attempt", "drawn"])

    state = cut(found.withColumn("attempt", F.lit(0)).mapInArrow(run, "kind string, form string, attempt int, drawn string"))
    for _ in range(MOST_ATTEMPTS):
        # entities and surrogates meet by value; names and numbers of other kinds don't matter
        held = state.groupBy("kind", F.col("drawn").alias("value")).agg(F.min(F.struct("attempt", "form")).alias("keeps"), F.count("*").alias("n"))
        taken = held.join(found.select("kind", F.col("form").alias("value"), F.lit(True).alias("real")), ["kind", "value"], "left").filter("n > 1 or real")
        judged = state.join(taken.withColumnRenamed("value", "drawn"), ["kind", "drawn"], "left")
        loses = F.col("real").isNotNull() | (F.col("n").isNotNull() & (F.col("keeps.form") != F.col("form")))
        judged = cut(judged.select("kind", "form", "attempt", "drawn", loses.alias("loses")))
        losers = judged.filter("loses").select("kind", "form", (F.col("attempt") + 1).alias("attempt"))
        if losers.isEmpty():
            return state.filter("attempt > 0").select("kind", "form", "attempt")
        state = cut(judged.filter("not loses").drop("loses").unionByName(losers.mapInArrow(run, "kind string, form string, attempt int, drawn string")))
    raise RuntimeError("a kind has too few surrogates for its entities")


def pseudonymize(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the text rewritten, and n_entities int.

    Null texts stay null with 0 entities; texts without entities stay as they are. All other columns and
    repeated rows are kept; a column n_entities is replaced. A name is found behind a title, and then wherever it stands
    in that text, so that all mentions of a person change alike. Surrogates of a format whose pool is full keep less
    of the format (another private range, another area code); RuntimeError if even these don't suffice. The key is a secret parameter: equal keys and tables give equal surrogates.
    """
    secret = key.encode()
    docs = docs.drop("n_entities")
    spare = "_" * (1 + max(map(len, docs.columns)))  # no column has this name
    small_batches(docs.sparkSession, 500, "4m")

    def detect(batches):
        for b in batches:
            found = {(kind, form) for t in b.column(0).to_pylist() if t for _, _, kind, form in entities(t)}
            if found:
                yield pa.record_batch([pa.array(c, pa.string()) for c in zip(*found)], ["kind", "form"])

    found = cut(docs.select(text_col).mapInArrow(detect, "kind string, form string").distinct())
    redrawn = cut(attempts(found, secret))
    held: dict[tuple[str, str], int] = {}
    marked = docs.withColumn(spare, F.lit(None).cast("map<string,int>"))
    if redrawn.count() <= HELD_ATTEMPTS:
        held = {(r["kind"], r["form"]): r["attempt"] for r in redrawn.collect()}
    else:
        small_batches(docs.sparkSession, 500, "4m")

        def uses(batches):
            for b in batches:
                rows = {(tag, kind, form) for tag, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if t for _, _, kind, form in entities(t)}
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))], ["tag", "kind", "form"])

        tag = F.xxhash64(text_col)
        used = docs.select(tag.alias("tag"), text_col).mapInArrow(uses, "tag long, kind string, form string").distinct()
        maps = used.join(redrawn, ["kind", "form"]).groupBy("tag").agg(F.map_from_entries(F.collect_set(F.struct(F.concat("kind", F.lit("\0"), "form"), "attempt"))).alias("m"))
        found_ = maps.select(F.col("tag").alias(f"{spare}tag"), F.col("m").alias(spare))
        marked = docs.withColumn(f"{spare}tag", tag).join(found_, f"{spare}tag", "left").drop(f"{spare}tag")
    columns = docs.columns
    place = columns.index(text_col)

    def rewrite(batches):
        for b in batches:
            texts, counts = [], []
            for t, own in zip(b.column(place).to_pylist(), b.column(len(columns)).to_pylist()):
                own = dict(own or {})
                spans, out, at = entities(t) if t else [], [], 0
                for s, e, kind, form in spans:
                    attempt = own.get(f"{kind}\0{form}", held.get((kind, form), 0))
                    out += [t[at:s], render(draw(secret, kind, form, attempt), t[s:e], kind)]
                    at = e
                texts.append("".join([*out, t[at:]]) if t else t)
                counts.append(len(spans))
            cols = [pa.array(texts, pa.string()) if i == place else b.column(i) for i in range(len(columns))]
            yield pa.record_batch([*cols, pa.array(counts, pa.int32())], [*columns, "n_entities"])

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes) + ", n_entities int"
    small_batches(docs.sparkSession, 500, "4m")
    return marked.select(*columns, spare).mapInArrow(rewrite, schema)
