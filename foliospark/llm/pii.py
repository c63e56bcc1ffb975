"""Surrogates for personal data: keyed, type-consistent replacements.

An entity's characters are permuted by a keyed Feistel network within their own alphabets: digits stay digits, vowels
vowels, consonants consonants, in their script and case, so different entities of one shape get different surrogates
and equal ones the same wherever and however they are written. Given names come from lists of their gender and script.
The corpus' entities are collected once to find surrogates that collide or that are real entities; those alone are
drawn anew until none is left, at last in longer and longer shapes, and become exceptions of the replacement.

A name is found behind a title; from then on its parts are replaced wherever they recur in the text, with a title or
without, in capitals or not, by the same surrogate in the same case.
"""

from __future__ import annotations

import hashlib
import hmac
import itertools
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, flag_members, materialize, read_table

#: Key of the registered query; production passes a secret one.
KEY = b"public demonstration key"
#: Draws for an entity in its own shape; those after them are in longer ones.
ATTEMPTS = 12
#: So many exceptions are sent to every worker; more are joined to the documents that need them.
BROADCAST_EXCEPTIONS = 50_000

#: Given names by script and gender (fixed values).
GIVEN = {
    ("latin", "f"): "Anna Clara Elena Emma Greta Ines Julia Laura Lena Lucia Maria Marta Nina Nora Paula Rosa Sara Sofia Teresa Vera".split(),
    ("latin", "m"): "Adrian Bruno Carl David Emil Felix Hugo Ivan Jonas Karl Leo Lukas Marco Martin Oscar Paul Peter Simon Thomas Victor".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Ирина Мария Нина Ольга Полина".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Иван Максим Никита Олег Павел".split(),
    ("greek", "f"): "Άννα Ελένη Ειρήνη Μαρία Νίκη Σοφία".split(),
    ("greek", "m"): "Αλέξης Γιώργος Δημήτρης Νίκος Πέτρος Σπύρος".split(),
}
#: Titles before names and the gender they tell (fixed values).
TITLES = {
    "Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Sir": "m", "господин": "m", "Κύριος": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f", "госпожа": "f", "Κυρία": "f", "Dr": "", "Prof": "",
}
#: Given names of men that end like those of women (fixed values).
MEN = "luca nikita joshua andrea sasha misha ilya kolya никита илья лука фома саша миша данила".split()
#: Alphabets that map onto themselves, lower case.
ALPHABETS = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "äëïöüáéíóúàèìòùâêîôû", "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ")
_PLACE = {c: (k, i) for k, a in enumerate(ALPHABETS) for i, c in enumerate(a)}

_LOCAL = re.compile(r"[\w.+%-]")
_PREFIX = "(?:sk|pk|ghp|AKIA)"
_WORD = re.compile(r"\b[^\W\d_a-zа-яα-ω][^\W\d_]+\b")
_CAP = r"[^\W\d_a-zа-яα-ω][^\W\d_]+"
PATTERNS = (
    ("email", re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")),  # the local part is sought backwards, by local_start
    ("secret", re.compile(rf"(?<![0-9A-Za-z])(?:[0-9a-f]{{32,}}+|[0-9A-F]{{32,}}+|{_PREFIX}(?:[_-](?!{_PREFIX}[_-])[0-9A-Za-z]{{1,15}}(?![0-9A-Za-z]))*+[_-]?[0-9A-Za-z]{{16,}}+(?:[_-][0-9A-Za-z]+)*+)(?![0-9A-Za-z])")),
    ("iban", re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])")),
    ("card", re.compile(r"(?<![\d.])(?:\d[ -]?){12,18}\d(?![\d.]*\d)")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("ip", re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)")),
    ("phone", re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}(?:[ .-]?\d{2,4}){1,3}(?!\w|[.-]\d)")),
    ("name", re.compile(rf"\b(?P<title>{'|'.join(sorted(TITLES, key=len, reverse=True))})\b\.? (?P<first>{_CAP})(?: (?P<last>{_CAP}))?")),
)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_check(body: str, country: str) -> str:
    number = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{98 - int(number) % 97:02d}"


@lru_cache(maxsize=200_000)
def _digest(key: bytes, message: str) -> int:
    return int.from_bytes(hmac.new(key, message.encode("utf-8", "replace"), hashlib.sha256).digest(), "big")


def _fold(c: str) -> str:
    """The character in lower case if upper case leads back."""
    low = c.lower()
    return low if len(low) == 1 and low.upper() == c else c


def _class(c: str) -> tuple[str, str, int, int]:
    """Script, kind and range of code points of a letter or digit outside ALPHABETS."""
    kind = "digit" if c.isdecimal() else "number" if not c.isalpha() else "cased" if _fold(c.upper()) == c != c.upper() else "letter"
    low, high = next(((a, b) for a, b in ((0x4E00, 0x9FFF), (0xAC00, 0xD7A3)) if a <= ord(c) <= b), (ord(c) & ~0xFF, ord(c) | 0xFF))
    return unicodedata.name(c, "").partition(" ")[0], kind, low, high


@lru_cache(maxsize=None)
def _members(group: tuple[str, str, int, int]) -> tuple[str, dict[str, int]]:
    """The alphabet of a class and the place of each character in it."""
    found = "".join(c for c in map(chr, range(group[2], group[3] + 1)) if c.isalnum() and c not in _PLACE and _fold(c) == c and _class(c) == group)
    return found, {c: k for k, c in enumerate(found)}


@lru_cache(maxsize=100_000)
def _place(c: str) -> tuple[object, str, int]:
    """Name of the alphabet of a folded letter or digit, its characters and the character's place."""
    if c in _PLACE:
        group, at = _PLACE[c]
        return group, ALPHABETS[group], at
    group = _class(c)
    alphabet, places = _members(group)
    return group, alphabet, places[c]


def permute(key: bytes, tweak: str, text: str) -> str:
    """A keyed bijection of texts of one shape: each letter and digit stays in its alphabet, others and case stay as they are."""
    low = text.lower() if text.isascii() else "".join(map(_fold, text))
    at = [k for k, c in enumerate(low) if c.isalnum()]
    if not at:
        return text
    groups, alphabets, places = zip(*(_place(low[k]) for k in at), strict=True)
    values = list(places)
    half = len(at) // 2
    shape = f"{tweak}|{''.join(map(str, groups))}"
    for turn in range(8):  # each side moves by a number that depends on the other one
        target, source = (range(half), values[half:]) if turn % 2 else (range(half, len(at)), values[:half])
        noise = _digest(key, f"{shape}|{turn}|{','.join(map(str, source))}")
        for i in target:
            size = len(alphabets[i])
            noise, step = divmod(noise, size) if noise > size**4 else divmod(_digest(key, f"{noise}|{i}"), size)
            values[i] = (values[i] + step) % size
    out = list(text)
    for k, a, v in zip(at, alphabets, values, strict=True):
        out[k] = a[v].upper() if low[k] != text[k] else a[v]
    return "".join(out)


def script_of(word: str) -> str:
    return "cyrillic" if re.search("[А-яЁё]", word) else "greek" if re.search("[Α-ωά-ώΆ-Ώ]", word) else "latin"


def gender_of(first: str, told: str) -> str:
    """Of a title, or of a given name in the lists, else of the usual ending."""
    if told:
        return told
    low = first.lower()
    for (_, gender), names in GIVEN.items():
        if low in map(str.lower, names):
            return gender
    return "f" if low[-1:] in "aаηα" and low not in MEN else "m"


def canonical(kind: str, text: str) -> str:
    """What an entity's writings have in common: names and addresses in lower case, numbers without separators."""
    if kind == "email":
        return text.lower()
    if kind in ("card", "phone", "ssn"):
        return re.sub(r"\D", "", text)
    if is_name(kind):
        return "".join(map(_fold, text))
    return text.replace(" ", "") if kind == "iban" else text


def is_name(kind: str) -> bool:
    return kind == "surname" or kind.startswith("given")


#: Tells the genders of a given name apart in longer shapes.
_MARKS = {("latin", "f"): "a", ("latin", "m"): "e", ("cyrillic", "f"): "а", ("cyrillic", "m"): "е", ("greek", "f"): "α", ("greek", "m"): "ε"}


def longer(text: str, attempt: int) -> str:
    """The text and, from attempt ATTEMPTS on, 1, 2, 4, ... of its own letters and digits, again and again."""
    own = "".join(c if text.isupper() else _fold(c) for c in text if c.isalnum()) or "0"
    return text + "".join(itertools.islice(itertools.cycle(own), 2 ** (attempt - ATTEMPTS))) if attempt >= ATTEMPTS else text


def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """The replacement of a canonical entity; another one for each attempt.

    From attempt ATTEMPTS on different entities of a kind (given names of all genders are one) have different surrogates
    at the same attempt, each longer than at the attempt before.
    """
    tweak = f"{kind}|{attempt}"
    if attempt >= ATTEMPTS and (kind.startswith("given") or kind in ("ip", "secret")):
        mark = _MARKS[tuple(kind.split(":")[1:])] if ":" in kind else ""
        return permute(key, f"{kind.split(':')[0]}|{attempt}", longer(entity + mark, attempt))
    if kind == "email":
        name, _, domain = entity.rpartition("@")
        name = longer(name, attempt)
        labels = domain.split(".")
        return permute(key, tweak, name) + "@" + ".".join([permute(key, tweak + "|domain", x) for x in labels[:-1]] + labels[-1:])
    if kind == "card":
        body = entity[0] + permute(key, tweak, longer(entity[1:-1], attempt))
        return next(body + d for d in "0123456789" if luhn(body + d))
    if kind == "iban":
        body = permute(key, tweak, longer(entity[4:], attempt))
        return entity[:2] + iban_check(body, entity[:2]) + body
    if kind == "ip":
        octets = [int(x) for x in entity.split(".")]
        for turn in range(6):  # a keyed bijection of four octets
            i = turn % 4
            rest = ".".join(str(x) for k, x in enumerate(octets) if k != i)
            octets[i] = (octets[i] + _digest(key, f"{tweak}|{turn}|{rest}")) % 256
        return ".".join(map(str, octets))
    if kind in ("phone", "ssn"):
        keep = max(0, len(entity) - 10) if kind == "phone" else 0
        return entity[:keep] + permute(key, tweak, longer(entity[keep:], attempt))
    if kind.startswith("given"):
        script, gender = kind.split(":")[1:]
        names = GIVEN[script, gender]
        found = names[_digest(key, f"{tweak}|{entity}") % len(names)]
        return found if attempt < 4 else found + permute(key, tweak, entity.lower())
    if kind == "secret":  # hexadecimal letters stay hexadecimal
        digits = "0123456789abcdef" if re.fullmatch("[0-9a-f]+", entity) else "0123456789ABCDEF" if re.fullmatch("[0-9A-F]+", entity) else None
        if digits is None:
            return entity[:4] + permute(key, tweak, entity[4:])
        parts = range(-(-len(entity) // 128))
        noise = "".join(hmac.new(key, f"{tweak}|{entity}{f'|{k}' if k else ''}".encode(), hashlib.sha512).hexdigest() for k in parts)
        return "".join(digits[int(c, 16)] for c in noise[: len(entity)])
    return permute(key, tweak, longer(entity, attempt))


def local_start(text: str, at: int, least: int) -> int:
    """Where the local part before the @ at `at` begins: at a letter or digit, not before `least`; `at` if there is none."""
    start = at
    while start > least and _LOCAL.match(text, start - 1):
        start -= 1
    while start < at and not text[start].isalnum():
        start += 1
    return start


def entities(text: str | None) -> list[tuple[int, int, str, str]]:
    """start, end, kind and canonical form of each entity, in order and without overlap; the earlier pattern wins."""
    if not text:
        return []
    taken: list[tuple[int, int, str, str]] = []
    covered = bytearray(len(text))

    def put(a: int, b: int, kind: str, entity: str) -> None:
        if not any(covered[a:b]):
            covered[a:b] = b"\x01" * (b - a)
            taken.append((a, b, kind, entity))

    for kind, pattern in PATTERNS:
        end = 0
        for m in pattern.finditer(text):
            if kind == "email":
                start = local_start(text, m.start(), end)
                if start < m.start():
                    end = m.end()
                    put(start, end, kind, canonical(kind, text[start:end]))
            elif kind == "name":
                first, last = m["first"], m["last"]
                if last:
                    given = f"given:{script_of(first)}:{gender_of(first, TITLES[m['title']])}"
                    put(*m.span("first"), given, canonical(given, first))
                    put(*m.span("last"), "surname", canonical("surname", last))
                else:
                    put(*m.span("first"), "surname", canonical("surname", first))
            elif kind == "card" and not luhn(canonical(kind, m[0])):
                put(*m.span(), "phone" if len(canonical(kind, m[0])) < 13 else "number", canonical("card", m[0]))
            elif kind == "iban" and iban_check(canonical(kind, m[0])[4:], m[0][:2]) != m[0][2:4]:
                continue
            else:
                put(*m.span(), kind, canonical(kind, m[0]))
    names = {entity: kind for _, _, kind, entity in sorted(taken, reverse=True) if is_name(kind)}
    if names:  # the first kind of a name in the text is that of its recurrences
        for m in _WORD.finditer(text):
            entity = canonical("surname", m[0])
            if entity in names:
                put(*m.span(), names[entity], entity)
    return sorted(taken)


def rendered(kind: str, written: str, entity: str, replacement: str) -> str:
    """The replacement in the form in which the entity was written: its separators and its case."""
    if is_name(kind):
        if len(written) > 1 and written.isupper():
            return replacement.upper()
        return "".join(c.upper() if written[k : k + 1].isupper() else c for k, c in enumerate(replacement))
    if written == entity:
        return replacement
    if len(re.sub(r"[\W_]", "", written)) == len(replacement) and written.lower() != entity:
        rest = iter(replacement)
        return "".join(next(rest) if c.isalnum() else c for c in written)
    return "".join(c.upper() if w.isupper() else c for w, c in zip(written, replacement, strict=True)) if len(written) == len(replacement) else replacement


def replace(text: str | None, key: bytes, exceptions: dict[str, int]) -> tuple[str | None, int, str | None]:
    """The text with surrogates, the number of entities and their kinds."""
    found = entities(text)
    if not found:
        return text, 0, None
    out, at = [], 0
    for a, b, kind, entity in found:
        out += [text[at:a], rendered(kind, text[a:b], entity, surrogate(key, kind, entity, exceptions.get(f"{kind}\t{entity}", 0)))]
        at = b
    return "".join(out) + text[at:], len(found), ",".join(sorted({k.split(":")[0] for _, _, k, _ in found}))


def entity_column() -> Callable[[Column], Column]:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([sorted({f"{k}\t{e}" for _, _, k, e in entities(t if isinstance(t, str) else None)}) for t in texts], dtype=object)

    return F.pandas_udf(run, "array<string>")


def drawn(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """An entity's surrogate as it is compared with others and with real entities: by kind without script and gender, and folded."""
    return f"{kind.split(':')[0]}\t{canonical(kind, surrogate(key, kind, entity, attempt))}"


def _draw_column(key: bytes) -> Callable[..., Column]:
    def run(keys: pd.Series, attempts: pd.Series) -> pd.Series:
        return pd.Series([drawn(key, *k.split("\t", 1), int(a)) for k, a in zip(keys, attempts, strict=True)], dtype=object)

    return F.pandas_udf(run, "string")


def exceptions_of(found: DataFrame, key: bytes) -> DataFrame:
    """entity and attempt (1 or more) of the entities whose first surrogate collides or is an entity of the corpus.

    Of entities that draw the same surrogate the first by name keeps it; the others draw again, as does one that draws
    what is an entity itself. This ends: from draw ATTEMPTS on, what is drawn together differs, and its doubling length
    passes that of all entities and of the surrogates settled before.
    """
    draw = _draw_column(key)
    plain = F.regexp_replace(F.col("entity"), r"^([a-z]+)(:[a-z:]+)?\t", "$1\t")
    real = found.select(plain.alias("surrogate")).distinct()
    state = materialize(found.withColumn("attempt", F.lit(0)).withColumn("surrogate", draw("entity", F.lit(0))), "pii-surrogates")
    for k in itertools.count(1):
        firsts = state.groupBy("surrogate").agg(F.min(F.struct("attempt", "entity")).alias("first"), F.count("*").alias("n"))
        clash = firsts.join(real.withColumn("is_real", F.lit(True)), "surrogate", "left").filter("n > 1 OR is_real")
        again = state.join(clash, "surrogate").filter(F.coalesce("is_real", F.lit(False)) | (F.col("entity") != F.col("first.entity")))
        again = materialize(again.select("entity"), "pii-again")
        if again.limit(1).count() == 0:
            return state.filter("attempt > 0").select("entity", "attempt")
        fresh = again.withColumn("attempt", F.lit(k)).withColumn("surrogate", draw("entity", F.lit(k)))
        state = materialize(state.join(again, "entity", "left_anti").unionByName(fresh), "pii-surrogates")


def replace_column(key: bytes, exceptions: dict[str, int] | None = None) -> Callable[..., Column]:
    """From a text (and a map of exceptions) to a struct of text, n_entities and kinds."""

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, own = (batch if isinstance(batch, tuple) else (batch, None))
            maps = [exceptions or {}] * len(texts) if own is None else [dict(m) if m is not None else {} for m in own]
            rows = [replace(t if isinstance(t, str) else None, key, m) for t, m in zip(texts, maps, strict=True)]
            yield pd.DataFrame(rows, columns=["text", "n_entities", "kinds"])

    def one(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from run(batches)

    def two(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        yield from run(batches)

    return F.pandas_udf(one if exceptions is not None else two, "text string, n_entities int, kinds string")


def replace_entities(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """For every row: doc_id, text with surrogates, n_entities and kinds (null without entities).

    A null text stays null and an empty one empty; whole texts are read, however long. Repeated rows get equal results;
    an empty table gives no rows. Other columns of docs, whatever their names, are not read.
    """
    bounded_batches(docs.sparkSession)
    found = docs.select(F.explode(entity_column()(F.col("text"))).alias("entity")).distinct()
    exceptions = materialize(exceptions_of(materialize(found, "pii-entities"), key), "pii-exceptions")
    if exceptions.count() <= BROADCAST_EXCEPTIONS:
        table = {r["entity"]: r["attempt"] for r in exceptions.collect()}
        told = docs.select("doc_id", replace_column(key, table)(F.col("text")).alias("__r"))
        return told.select("doc_id", "__r.*")
    rows = docs.select("doc_id", "text").withColumn("__k", F.sha2(F.coalesce("text", F.lit("")), 256))
    wanted = rows.select("__k", F.explode(entity_column()(F.col("text"))).alias("entity")).distinct().join(exceptions, "entity")
    maps = materialize(wanted.groupBy("__k").agg(F.map_from_entries(F.collect_list(F.struct("entity", "attempt"))).alias("__m")), "pii-maps")
    flagged = flag_members(rows, F.col("__k"), maps.select("__k"), "__hit")
    none = F.lit(None).cast(maps.schema["__m"].dataType)
    both = flagged.filter("NOT __hit").withColumn("__m", none).unionByName(flagged.filter("__hit").join(maps, "__k", "left"))
    return both.select("doc_id", replace_column(key)(F.col("text"), F.col("__m")).alias("__r")).select("doc_id", "__r.*")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(read_table(spark, sf_dir, "documents"))


QUERIES = {"op2_pii": op2_pii}
ORACLES: dict[str, str] = {}
