"""Personal data in texts, replaced by keyed surrogates of the same kind.

Mail addresses, telephone, card and social security numbers, network addresses, account numbers and titled names,
with all further mentions of these names in the same text, are found in whole texts.  Each is replaced by what a keyed hash draws for it: digits for digits and letters
for letters in their places, names of the same gender and script, numbers as valid as the original.  The draws of
all entities are checked against each other and against the originals of the whole table, and drawn again where
they meet, so different entities stay different; an entity has one surrogate wherever it occurs.
"""

from __future__ import annotations

import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.batches import pieces
from muster.session import discard, materialize

KEY = b"surrogates of muster"
KEY_SETTING = "muster.surrogates.key"
MAX_ROUNDS = 200
WIDEN = 8  # draws after which mail names and domains get one more letter or digit
LENGTHEN = 20  # draws after which names get longer
SHORT_ROUNDS = 2  # rounds before names take the length that their number needs; mail names and domains have three times as many

# Titles before names, by gender.
MALE = ["Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "г-н", "господин"]
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Srta", "Doña", "г-жа", "госпожа"]
NEUTRAL = ["Dr", "Prof", "Professor", "Doctor", "Doktor", "Docteur", "Dra"]
# Given names to draw from, by script and gender.
GIVEN = {
    ("LATIN", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Lukas", "Martin", "Noel", "Oscar", "Paul"],
    ("LATIN", "f"): ["Anna", "Bella", "Clara", "Diana", "Emma", "Flora", "Greta", "Helena", "Irene", "Julia", "Klara", "Laura", "Maria", "Nora", "Olivia", "Paula"],
    ("LATIN", "n"): ["Alex", "Billie", "Casey", "Dana", "Eden", "Frankie", "Gray", "Harper", "Indigo", "Jamie", "Kim", "Lee", "Morgan", "Nico", "Quinn", "Robin"],
    ("CYRILLIC", "m"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл"],
    ("CYRILLIC", "f"): ["Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Мария", "Нина"],
    ("CYRILLIC", "n"): ["Саша", "Женя", "Валя", "Слава"],
    ("GREEK", "m"): ["Αλέξης", "Γιώργος", "Νίκος", "Πέτρος"],
    ("GREEK", "f"): ["Άννα", "Ελένη", "Μαρία", "Σοφία"],
    ("GREEK", "n"): ["Άρης", "Δάφνη"],
}
SYLLABLES = {
    "LATIN": ["ba", "den", "fer", "gor", "hal", "ken", "lin", "mar", "nor", "per", "ros", "sten", "tal", "ver", "wil", "zan"],
    "CYRILLIC": ["бар", "вин", "гор", "дан", "зор", "кал", "лин", "мир", "нов", "пет", "рав", "сот"],
    "GREEK": ["βαν", "γιο", "δημ", "καλ", "λαμ", "μαν", "νικ", "παπ"],
}
_RESERVED = re.compile(r"(?:^|\.)(?:example\.(?:com|org|net)|test|invalid|example)$")

MAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
NUMBERS = re.compile(r"\d[\d ().\-]{5,}\d")
NUMBER = re.compile(
    r"(?P<ip>(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\d-])(?:\d{4}([ -])\d{4}\4\d{4}\4\d{1,7}|\d{4}([ -])\d{6}\5\d{5}|\d{13,19})(?![\d-]))"
    r"|(?P<phone>(?<![\d.-])\+?(?:\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?![\d-])|(?<![\d.-])\+\d{7,15}(?!\d)"
    r"|(?<![\d.-])\+\d{1,3}(?:[ .-]\d{2,4}){2,5}(?!\d))"
)
ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_TITLES = {t: g for g, titles in (("m", MALE), ("f", FEMALE), ("n", NEUTRAL)) for t in titles}
_WORD = r"[^\W\d_][\w'’]*(?:-[^\W\d_][\w'’]*)*"
TITLE = re.compile(rf"(?<!\w)({'|'.join(sorted(map(re.escape, _TITLES), key=len, reverse=True))})(?:\.[ ]?|[ ])(?={_WORD})")
NAME_WORD = re.compile(_WORD)
MENTION = re.compile(r"(?<!\w)[^\W\d_a-z][\w'’]*(?:-[^\W\d_][\w'’]*)*")
_POSSESSIVE = re.compile(r"['’][sS]?\Z")


def script(word: str) -> str:
    name = unicodedata.name(word[0], "LATIN").split()[0]
    return name if name in SYLLABLES else "LATIN"


def _luhn(digits: str) -> int:
    """Check digit that makes ``digits`` plus itself valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _titled(text: str, at: int) -> list[tuple[int, str]]:
    """Start and word of the capitalized words from ``at`` on, up to the next title; initials may have a point."""
    taken: list[tuple[int, str]] = []
    while (m := NAME_WORD.match(text, at)) and m[0][0].isupper():
        after = text[m.end():m.end() + 2]
        if m[0] in _TITLES and (m[0] != "Don" or after[:1] == "."):
            break
        word = _POSSESSIVE.sub("", m[0])
        taken.append((m.start(), word))
        if len(word) == 1 and after == ". ":
            at = m.end() + 2
        elif word == m[0] and after[:1] == " ":
            at = m.end() + 1
        else:
            break
    return taken


def _named(titled: list[tuple[str, list[tuple[int, str]]]]) -> list[tuple[int, int, str, str, str]]:
    """The entities of a text's titled names, given as gender of the title and words.

    The last word is the surname, unless it stands alone and is only a given name elsewhere in the text.  A given
    name has one gender in a text if its titles, or else those of the surnames after it, tell just one.
    """
    firsts = {word.casefold() for _, taken in titled for _, word in taken[:-1]}
    lasts = {taken[-1][1].casefold() for _, taken in titled if len(taken) > 1}
    told: dict[tuple[bool, str], set[str]] = {}
    parts = []
    for gender, taken in titled:
        alone = taken[0][1].casefold()
        given = len(taken) if len(taken) == 1 and alone in firsts and alone not in lasts else len(taken) - 1
        parts.append((gender, taken, given))
        if gender != "n":
            for i, (_, word) in enumerate(taken):
                told.setdefault((i < given, word.casefold()), set()).add(gender)
    out = []
    for gender, taken, given in parts:
        last = taken[-1][1].casefold()
        for i, (at, word) in enumerate(taken):
            norm, part = word.casefold(), "surname"
            if i < given:
                known = told.get((True, norm)) or (told.get((False, last), set()) if given < len(taken) else set())
                part = f"given-{min(known) if gender == 'n' and len(known) == 1 else gender}"
            out.append((at, at + len(word), part, f"{part}:{script(word)}", norm))
    return out


def _mentions(text: str, named: list[tuple[int, int, str, str, str]]) -> list[tuple[int, int, str, str, str]]:
    """Every other capitalized mention of the parts of ``named``, the titled names of a text.

    A word that is a given name and a surname there is the given name before another part, else the surname.
    Initials are no mentions.
    """
    roles: dict[str, dict[bool, tuple[str, str]]] = {}
    for start, end, part, space, norm in named:
        if end - start > 1:
            roles.setdefault(norm, {}).setdefault(part == "surname", (part, space))
    seen, words = {e[0] for e in named}, []
    for m in MENTION.finditer(text):
        word = _POSSESSIVE.sub("", m[0])
        if not word[:1].isupper():
            continue
        if word.casefold() in roles:
            words.append((m.start(), word))
        elif "-" in word:
            words += [(m.start() + w.start(), w[0]) for w in re.finditer(r"[^-]+", word) if w[0][0].isupper() and w[0].casefold() in roles]
    out = []
    for i, (at, word) in enumerate(words):
        if at in seen:
            continue
        own = roles[word.casefold()]
        before = i + 1 < len(words) and words[i + 1][0] == at + len(word) + 1 and text[at + len(word)] == " "
        part, space = own.get(not before) or own[before]
        out.append((at, at + len(word), part, space, word.casefold()))
    return out


def entities(text: str) -> list[tuple[int, int, str, str, str]]:
    """``start, end, kind, space, norm`` of the entities of a text, in order and without overlap.

    An entity is known by its ``norm`` within a ``space``: a mail address's name within its domain, the words of
    names by part, gender and script.
    """
    found: list[tuple[int, int, str, str, str]] = []
    if "@" in text:
        for m in MAIL.finditer(text):
            local, domain = m[0].lower().split("@")
            found.append((m.start(), m.start() + len(local), "mail", f"mail:{domain}", local))
            if not _RESERVED.fullmatch(domain) and not _RESERVED.search("." + domain) or domain.count(".") > 1:
                found.append((m.end() - len(domain), m.end(), "domain", "domain", domain))
    for region in NUMBERS.finditer(text):
        low = max(0, region.start() - 2)
        for m in NUMBER.finditer(text, low, region.end()):
            # Bounds are judged on the text, not on the region.
            if (m.end() < len(text) and text[m.end()].isdigit()) or (m.start() and (text[m.start() - 1].isalnum())):
                continue
            kind = m.lastgroup or "phone"
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            norm = m[0] if kind == "ip" else "".join(c for c in m[0] if c.isdigit())
            if kind == "phone" and not 7 <= len(norm) <= 15:
                continue
            found.append((m.start(), m.end(), kind, f"{kind}:{len(norm) if kind != 'ip' else 4}", norm))
    if re.search(r"[A-Z]{2}\d\d", text):
        for m in ACCOUNT.finditer(text):
            norm = m[0].replace(" ", "")
            if 15 <= len(norm) <= 34 and sum(c.isdigit() for c in norm) >= 10:
                found.append((m.start(), m.end(), "account", f"account:{len(norm)}", norm))
    if any(t in text for t in _TITLES):
        named = _named([(_TITLES[m[1]], taken) for m in TITLE.finditer(text) if (taken := _titled(text, m.end()))])
        found += named + (_mentions(text, named) if named else [])
    found.sort(key=lambda x: (x[0], -x[1]))
    kept: list[tuple[int, int, str, str, str]] = []
    for e in found:
        if not kept or e[0] >= kept[-1][1]:
            kept.append(e)
    return kept


class Draw:
    """Endless keyed numbers for one entity and attempt."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.seed, self.count, self.pool = key, "\x1f".join(parts).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hmac.digest(self.key, self.seed + self.count.to_bytes(4, "big"), "sha256")
            self.count += 1
        value, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return value % n


def _shaped(draw: Draw, text: str) -> str:
    """Letters for letters and digits for digits, all else in place."""
    return "".join(
        chr(48 + draw.below(10)) if c.isdigit() else chr(97 + draw.below(26)) if "a" <= c <= "z" else chr(65 + draw.below(26)) if "A" <= c <= "Z" else c
        for c in text)


def _more(draw: Draw, text: str, attempt: int) -> str:
    """What widens a mail name or domain after many draws: digits after a digit, else letters."""
    return "".join(str(draw.below(10)) if text[-1:].isdigit() else chr(97 + draw.below(26)) for _ in range(attempt // WIDEN))


def surrogate(space: str, norm: str, key: bytes, attempt: int) -> str:
    """The ``attempt``-th draw for an entity, in the form its norm has."""
    draw = Draw(key, space, norm, str(attempt))
    kind, _, detail = space.partition(":")
    if kind == "ip":
        small = norm.startswith("192.168.") and attempt < WIDEN  # the other private network has room for more
        first = "192" if small else "10" if norm.startswith(("10.", "192.168.")) else str(11 + draw.below(115))
        second = "168" if small else str(draw.below(256))
        return ".".join([first, second, str(draw.below(256)), str(1 + draw.below(254))])
    if kind == "card":
        body = norm[0] + "".join(str(draw.below(10)) for _ in norm[1:-1])
        check = _luhn(body)
        return body + str(check if _luhn(norm[:-1]) == int(norm[-1]) else (check + 1 + draw.below(9)) % 10)
    if kind == "ssn":
        return f"{1 + draw.below(665):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}"
    if kind == "phone":
        kept = max(1, len(norm) - 10)  # the country's code, or the first digit
        start = norm[:kept] + (str(2 + draw.below(8)) if len(norm) > 10 else "")
        return start + "".join(str(draw.below(10)) for _ in range(len(norm) - len(start)))
    if kind == "account":
        return norm[:2] + _shaped(draw, norm[2:])
    if kind == "domain":
        fixed = _RESERVED.search(norm)
        head, tail = (norm[:fixed.start()], norm[fixed.start():]) if fixed and fixed.start() else (norm.rpartition(".")[0], norm[norm.rfind("."):])
        return _shaped(draw, head) + _more(draw, head, attempt) + tail
    if kind.startswith("given"):
        names = GIVEN[detail, kind[-1]]
        name = names[draw.below(len(names))].casefold()
        # Beyond as many entities as names, a second name is joined on.
        return name if attempt < LENGTHEN else f"{name}-{names[draw.below(len(names))].casefold()}" + "".join(SYLLABLES[detail][draw.below(len(SYLLABLES[detail]))] for _ in range((attempt - LENGTHEN) // LENGTHEN))
    if kind == "surname":
        own = SYLLABLES[detail]
        return "".join(own[draw.below(len(own))] for _ in range(2 + (len(norm) > 5) + (len(norm) > 8) + attempt // LENGTHEN))
    return _shaped(draw, norm) + _more(draw, norm, attempt)


def draw_number(space: str, entities_of_space: int, turn: int) -> int:
    """Which draw an entity takes in a round, so that few rounds settle a space of any size.

    After the first rounds, names take at once as many words or syllables as give four times as many names as the
    space has entities; mail names and domains as many further letters or digits.
    """
    kind, _, detail = space.partition(":")
    room = 4 * entities_of_space
    if kind.startswith("given"):
        names = len(GIVEN[detail, kind[-1]])
        if turn < SHORT_ROUNDS or room <= 2 * names:
            return turn
        longer, has = 1, names * names
        while has < room:
            longer, has = longer + 1, has * len(SYLLABLES[detail])
        return turn + LENGTHEN * longer
    if kind == "surname" and turn >= SHORT_ROUNDS:
        longer, has = 0, len(SYLLABLES[detail]) ** 2
        while has < room:
            longer, has = longer + 1, has * len(SYLLABLES[detail])
        return turn + LENGTHEN * longer
    if kind in ("mail", "domain") and turn >= 3 * SHORT_ROUNDS:
        return turn + WIDEN * len(str(room))
    return turn


def render(kind: str, surface: str, made: str) -> str:
    """The surrogate in the format of the text: signs where they were, capitals as they were."""
    if kind in ("phone", "card", "ssn", "account"):
        rest = iter(made)
        return "".join(next(rest, "") if c.isalnum() else c for c in surface) + "".join(rest)
    if kind == "ip":
        return made
    if kind in ("mail", "domain"):
        return "".join(m.upper() if c.isupper() else m for c, m in zip(surface, made)) if len(made) == len(surface) else made
    if surface.isupper() and len(surface) > 1:
        return made.upper()
    return "-".join(w[:1].upper() + w[1:] for w in made.split("-")) if surface[:1].isupper() else made


def resolve(found: DataFrame, key: bytes) -> DataFrame:
    """``space, norm, surrogate`` of every entity in ``found`` (``space, norm``, each once).

    A draw that is an original of its space, that a settled entity has, or that an entity of lesser hash also drew,
    is drawn again.  All checks are joins and aggregations over the table.
    """
    schema = "space string, norm string, h long, size long, surrogate string"
    sizes = found.groupBy("space").agg(F.count(F.lit(1)).alias("size"))
    open_ones = materialize(found.join(sizes, "space").select("space", "norm", F.xxhash64("space", "norm").alias("h"), "size"), "entities")
    settled = None
    for attempt in range(MAX_ROUNDS):
        def draw(batches: Iterator[pa.RecordBatch], attempt=attempt) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = zip(*(batch.column(c).to_pylist() for c in ("space", "norm", "size")))
                made = [surrogate(s, n, key, draw_number(s, size, attempt)) for s, n, size in rows]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], ["space", "norm", "h", "size", "surrogate"])

        drawn = materialize(open_ones.mapInArrow(draw, schema), "drawn")
        first = drawn.groupBy("space", "surrogate").agg(F.min(F.struct("h", "norm")).alias("w"))
        fresh = first.join(found.select("space", F.col("norm").alias("surrogate")), ["space", "surrogate"], "left_anti")
        if settled is not None:
            fresh = fresh.join(settled.select("space", "surrogate"), ["space", "surrogate"], "left_anti")
        won = materialize(fresh.select("space", F.col("w.norm").alias("norm"), "surrogate"), "won")
        settled = won if settled is None else settled.unionByName(won)
        rest = materialize(open_ones.join(won, ["space", "norm"], "left_anti"), "entities")
        discard(drawn)
        open_ones = rest
        if open_ones.isEmpty():
            return settled
    raise RuntimeError(f"surrogates not settled after {MAX_ROUNDS} draws")


def _genders(found: DataFrame) -> DataFrame:
    """``space, norm, as``: given names after neutral titles only, and the space of the one gender the table knows them by."""
    given = found.filter("space LIKE 'given-%'").select("norm", F.substring("space", 7, 1).alias("gender"), F.expr("substring(space, 9)").alias("script"))
    known = given.groupBy("norm", "script").agg(F.collect_set("gender").alias("g"))  # of three at most
    one = known.filter("array_contains(g, 'n') AND size(g) = 2")
    return one.select(F.concat(F.lit("given-n:"), "script").alias("space"), "norm",
                      F.concat(F.lit("given-"), F.element_at(F.array_remove("g", "n"), 1), F.lit(":"), "script").alias("as"))


def replace_entities(docs: DataFrame, text_col: str = "text", key: bytes | None = None, count_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` with surrogates in their texts, all other columns as they are.

    ``count_col`` adds the number of entities replaced.  Texts without entities, null and empty ones are unchanged;
    repeated rows get the same text.  Without ``key``, that of the session's ``muster.surrogates.key`` is used.
    """
    spark = docs.sparkSession
    key = key or spark.conf.get(KEY_SETTING, KEY.decode()).encode()
    inner = [f"_in{i}" for i in range(len(docs.columns))]
    text = inner[docs.columns.index(text_col)]
    rows = docs.toDF(*inner)
    types = [f"{n} {f.dataType.simpleString()}" for n, f in zip(inner, rows.schema.fields)]
    span = "struct<start:int,end:int,kind:string,space:string,norm:string>"
    span_type = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("space", pa.string()), ("norm", pa.string())])

    def part(with_entities: bool):
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = TaskContext.get().partitionId() << 40
            for batch in pieces(batches, text):
                found = [entities(t) if t else [] for t in batch.column(text).to_pylist()]
                chosen = [i for i, own in enumerate(found) if bool(own) == with_entities]
                if not chosen:
                    continue
                kept = batch.take(pa.array(chosen))
                if with_entities:
                    spans = [[dict(zip(("start", "end", "kind", "space", "norm"), e)) for e in found[i]] for i in chosen]
                    numbers = pa.array(range(number, number + len(chosen)), pa.int64())
                    number += len(chosen)
                    kept = pa.RecordBatch.from_arrays([*kept.columns, numbers, pa.array(spans, pa.list_(span_type))], [*inner, "_row", "_spans"])
                yield kept

        return find

    affected = rows.mapInArrow(part(True), ", ".join([*types, "_row long", f"_spans array<{span}>"]))
    affected = materialize(affected, "affected")
    plain = rows.mapInArrow(part(False), ", ".join(types))
    spans = affected.select("_row", F.explode("_spans").alias("s")).select("_row", "s.start", "s.end", "s.kind", "s.space", "s.norm")
    distinct = materialize(spans.select("space", "norm").distinct(), "distinct")
    told = _genders(distinct)
    mapping = resolve(materialize(distinct.join(told.select("space", "norm"), ["space", "norm"], "left_anti"), "told"), key)
    same = told.join(mapping.withColumnRenamed("space", "as"), ["as", "norm"]).select("space", "norm", "surrogate")
    mapping = materialize(mapping.unionByName(same), "mapping")
    by_row = spans.join(mapping, ["space", "norm"]).groupBy("_row").agg(F.collect_list(F.struct("start", "end", "kind", "surrogate")).alias("_new"))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            texts = []
            for old, new in zip(batch.column(text).to_pylist(), batch.column("_new").to_pylist()):
                out, at = [], 0
                for s in sorted(new, key=lambda s: s["start"]):
                    out += [old[at:s["start"]], render(s["kind"], old[s["start"]:s["end"]], s["surrogate"])]
                    at = s["end"]
                texts.append("".join([*out, old[at:]]))
            columns = [pa.array(texts, pa.string()) if n == text else batch.column(n) for n in inner]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("_n")], [*inner, "_n"])

    changed = affected.drop("_spans").join(by_row, "_row").drop("_row").withColumn("_n", F.size("_new").cast("long"))
    changed = changed.mapInArrow(replace, ", ".join([*types, "_n long"]))
    result = plain.withColumn("_n", F.lit(0).cast("long")).unionByName(changed)
    named = result.select(*[F.col(i).alias(c) for i, c in zip(inner, docs.columns)], "_n")
    return named.withColumnRenamed("_n", count_col) if count_col else named.drop("_n")
