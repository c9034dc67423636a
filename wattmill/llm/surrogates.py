"""Replacement of personal data and secrets by surrogates.

Entities are found by pattern in every whole text. Each distinct entity of the corpus gets one surrogate, drawn by a keyed hash
(HMAC-SHA256), of the same type and in the same format: e-mail addresses stay addresses in a reserved domain, telephone and card numbers keep
their punctuation, country code, first digit and a valid check digit, IP addresses stay addresses (in the reserved block
240.0.0.0/4), secrets keep length and alphabet, given names keep gender and script, family names keep script. Names are found after
a form of address and as a known given name before a capitalised word, with one middle name at most; given and family names are entities
of their own, so "Anna Berg", "Frau Berg" and "ANNA BERG" agree with each other afterwards. All names found in a text are looked for again in
that whole text, so lone mentions of their parts ("Berg went, Anna stayed") get the same surrogates; only capitalised words count.

Surrogates are checked over the whole corpus: two entities never share one, and none equals an entity that occurs. Entities that
fail draw again, the others keep theirs, until none fails. From the attempt ``SAME_FORMAT`` on surrogates grow with each attempt, two
digits or letters at a time (names by a syllable each four attempts, addresses as IPv6 addresses of 2001:db8::/32), so a format that is used up ends no run. A
secret without letters or digits, which has nothing to redraw, becomes hexadecimal digits.

Only texts that hold entities are shuffled, and only distinct (text, entity) pairs meet the table of surrogates, by an equi-join that
Spark can split; an entity in a third of all texts is one row of that table.

Nulls: a null text stays null. Rows of equal text get equal replacements. Empty table: empty result. All columns of ``docs`` are kept as
they are, but for the text; ``surrogate_texts`` adds none.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.llm.common import arrow_schema, fresh, saved, struct

KEY = b"surrogates"  # a parameter: production passes its own secret
SAME_FORMAT = 4  # attempts before a surrogate gets longer than its entity

# fixed values: forms of address with the gender they tell, and given names by gender
ADDRESS = {
    "m": ("Mr", "Mister", "Herr", "Herrn", "Monsieur", "Señor", "Sir", "г-н", "господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Señorita", "г-жа", "госпожа"),
    "n": ("Dr", "Prof"),
}
GIVEN = {
    "m": ("James John Robert Michael William David Thomas Daniel Peter Paul Hans Karl Jürgen Stefan Pierre Jean Michel Jacques José Carlos Miguel Juan Pedro Иван Сергей Дмитрий Алексей").split(),
    "f": ("Mary Anna Emma Laura Sarah Julia Elizabeth Jennifer Susan Linda Ursula Petra Sabine Marie Sophie Claire Camille María Carmen Lucía Isabel Мария Елена Ольга Наталья").split(),
}
# syllables that surrogate names are built of, by script
SYLLABLES = {
    "latin": ("ba be bo da de di do fa fe ga ge ha ka ke ki la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se so ta te ti to va ve vi wa").split(),
    "cyrillic": ("ба бе бо да де ди до ка ке ла ле ли ло ма ме ми на не ни но ра ре ри ро са се та те ти ва ве ви").split(),
    "greek": ("βα δε δο κα κε λα λε λι μα με μι να νε νι πα πε ρα ρε ρι σα σε τα τε τι").split(),
}
ENDINGS = {
    "latin": {"m": "n r s l d k".split(), "f": "a ia ina ella".split(), "n": "y".split(), "family": "mann ler son ner sen ard".split()},
    "cyrillic": {"m": "н р й м".split(), "f": "а я ина".split(), "n": "о".split(), "family": "нко чук ренко".split()},
    "greek": {"m": "ς ος".split(), "f": "α η".split(), "n": "ι".split(), "family": "ίδης άκης".split()},
}

GENDER_OF = {name.casefold(): g for g, names in GIVEN.items() for name in names}
GENDER_OF_ADDRESS = {name.casefold(): g for g, names in ADDRESS.items() for name in names}

_NAME = r"[^\W\d_][^\W\d_'’-]*"
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    "secret": re.compile(r"\bAKIA[0-9A-Z]{16}\b|(?i:(?<=password=)|(?<=passwd=)|(?<=secret=)|(?<=token=)|(?<=api_key=)|(?<=token = \")|(?<=secret = \")|(?<=password = \"))[^\s\"',;]{6,}|(?<![0-9A-Za-z])(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{32,64}(?![0-9A-Za-z])"),
    "ip": re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"),
    "card": re.compile(r"(?<![\d.-])[3-6]\d{3}([ -]?)\d{4}\1\d{4}\1\d{3,4}(?![\d-])"),
    "phone": re.compile(r"(?<![\w.])\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4}(?!\w)|(?<![\w.])\(\d{3}\) ?\d{3}-\d{4}(?!\w)"),
    "address": re.compile(rf"\b({'|'.join(n for names in ADDRESS.values() for n in names)})(\.? +)({_NAME})(?: +({_NAME}))?(?: +({_NAME}))?"),
    "given": re.compile(rf"\b({'|'.join(sorted({n for names in GIVEN.values() for n in names} | {n.upper() for names in GIVEN.values() for n in names}, key=len, reverse=True))}) +({_NAME})(?: +({_NAME}))?"),
    "word": re.compile(_NAME),
}
# a text without any of these cannot hold the type: a cheap look before the pattern
HINTS = {"email": re.compile("@"), "secret": re.compile(r"AKIA|[=\"]|[0-9a-f]{32}"), "ip": re.compile(r"\d\.\d"), "card": re.compile(r"\d{3}"), "phone": re.compile(r"[+(]\d")}

MENTION = struct(start="int", stop="int", type="string", value="string")
DRAWN = struct(type="string", value="string", attempt="int", surrogate="string")


def script_of(name: str) -> str:
    first = ord(name[0])
    return "cyrillic" if 0x400 <= first < 0x530 else "greek" if 0x370 <= first < 0x400 or 0x1F00 <= first < 0x2000 else "latin"


def capital(word: str | None) -> bool:
    return bool(word) and len(word) > 1 and word[0].isupper()


def names_in(text: str) -> Iterator[tuple[int, int, str, str]]:
    def given(m: re.Match, group: int, gender: str) -> tuple[int, int, str, str]:
        word = m[group]
        gender = GENDER_OF.get(word.casefold(), gender)
        return m.start(group), m.end(group), f"given:{gender}:{script_of(word)}", word.casefold()

    def family(m: re.Match, group: int) -> tuple[int, int, str, str]:
        return m.start(group), m.end(group), f"family:{script_of(m[group])}", m[group].casefold()

    for m in PATTERNS["address"].finditer(text):
        if capital(m[3]):
            gender = GENDER_OF_ADDRESS[m[1].casefold()]
            if capital(m[4]):
                yield given(m, 3, gender)
                if capital(m[5]):  # a middle name
                    yield given(m, 4, GENDER_OF.get(m[3].casefold(), gender))
                    yield family(m, 5)
                else:
                    yield family(m, 4)
            else:
                yield family(m, 3)
    for m in PATTERNS["given"].finditer(text):
        if capital(m[2]):
            yield given(m, 1, "n")
            if capital(m[3]):
                yield given(m, 2, GENDER_OF[m[1].casefold()])
                yield family(m, 3)
            else:
                yield family(m, 2)


def mentions_of(names: list[tuple[int, int, str, str]], text: str) -> Iterator[tuple[int, int, str, str]]:
    """Every capitalised mention of the names found in the text, alone or not. A word that was found in two roles keeps the first."""
    kinds = {value: kind for _, _, kind, value in sorted(names, reverse=True)}
    for m in PATTERNS["word"].finditer(text) if kinds else ():
        value = m[0].casefold()
        if value in kinds and capital(m[0]):
            yield m.start(), m.end(), kinds[value], value


def identity(kind: str, mention: str) -> str:
    """What makes two mentions the same entity."""
    if kind == "email":
        return mention.lower()
    if kind == "phone":
        return ("+" if mention[0] == "+" else "") + re.sub(r"\D", "", mention)
    return re.sub(r"\D", "", mention) if kind == "card" else mention


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Non-overlapping (start, stop, type, value) in order; earlier types win where they overlap."""
    taken: list[tuple[int, int, str, str]] = []
    used = bytearray()

    def take(start: int, stop: int, kind: str, value: str) -> None:
        if not used:
            used.extend(bytes(len(text)))
        if not any(used[start:stop]):
            used[start:stop] = b"\1" * (stop - start)
            taken.append((start, stop, kind, value))

    for kind, hint in HINTS.items():
        if hint.search(text):
            for m in PATTERNS[kind].finditer(text):
                take(m.start(), m.end(), kind, identity(kind, m[0]))
    patterned = len(taken)
    for mention in names_in(text):
        take(*mention)
    for mention in mentions_of(taken[patterned:], text):
        take(*mention)
    return sorted(taken)


class Draws:
    """A stream of numbers that key, type, value and attempt decide."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.seed = hmac.new(key, f"{kind}\0{value}\0{attempt}".encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
        self.bits, self.left, self.block = 0, 0, 0

    def below(self, n: int) -> int:
        if self.left < 64:
            self.block += 1
            self.bits = (self.bits << 256) | int.from_bytes(hashlib.sha256(self.seed + self.block.to_bytes(8, "little")).digest(), "little")
            self.left += 256
        self.bits, found = divmod(self.bits, 1 << 64)
        self.left -= 64
        return found % n

    def like(self, text: str) -> str:
        """Digits for digits, letters for letters of the same case (beyond ASCII: of the same sixteen code points)."""
        out = []
        for c in text:
            base = 48 if "0" <= c <= "9" else 97 if "a" <= c <= "z" else 65 if "A" <= c <= "Z" else 0
            if base:
                out.append(chr(base + self.below(10 if base == 48 else 26)))
            elif c.isalnum():
                near = [chr(x) for x in range(ord(c) & ~15, (ord(c) | 15) + 1)]
                out.append(self.one_of([x for x in near if x.isalnum() and (x.isupper(), x.isdigit()) == (c.isupper(), c.isdigit())]))
            else:
                out.append(c)
        return "".join(out)

    def hex_like(self, text: str) -> str:
        return "".join("0123456789abcdef"[self.below(16)] for _ in text)

    def one_of(self, values: list[str]) -> str:
        return values[self.below(len(values))]


def check_digit(digits: str) -> str:
    total = sum(sum(divmod(int(d) * 2, 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def draw(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The surrogate of an entity, in the normal form of ``identity``."""
    d = Draws(key, kind, value, attempt)
    longer = 2 * max(0, attempt - SAME_FORMAT + 1)
    if kind == "email":
        local, domain = value.split("@")
        top = domain.rsplit(".", 1)[1]
        return f"{d.like(local + 'a' * longer)}@{d.like(domain.split('.')[0])}.example.{top if top in ('com', 'org', 'net') else 'com'}"
    if kind == "phone":
        keep = (2 if value[1] in "17" else 3) if value[0] == "+" else 0  # plus sign and country code
        return value[:keep] + str(2 + d.below(8)) + d.like(value[keep + 1 :] + "0" * longer)
    if kind == "card":
        body = value[0] + d.like(value[1:-1] + "0" * longer)
        luhn = check_digit(value[:-1]) == value[-1]
        last = check_digit(body)
        return body + (last if luhn else str((int(last) + 1 + d.below(9)) % 10))
    if kind == "ip" and longer:
        return "2001:db8:" + ":".join(d.hex_like("0000") for _ in range(6))
    if kind == "ip":
        return f"{240 + d.below(15)}.{d.below(256)}.{d.below(256)}.{1 + d.below(254)}"
    if kind == "secret":
        if value.startswith("AKIA"):
            return "AKIA" + "".join(d.one_of(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")) for _ in value[4:] + "A" * longer)
        if re.fullmatch("[0-9a-f]+", value) or not any(c.isalnum() for c in value):
            return d.hex_like("0" * max(len(value), 0 if value.isalnum() else 32) + "0" * longer)
        return d.like(value + "a" * longer)
    what, *rest = kind.split(":")
    script = rest[-1]
    ending = ENDINGS[script][rest[0] if what == "given" else "family"]
    return "".join(d.one_of(SYLLABLES[script]) for _ in range(2 + d.below(2) + attempt // 4)) + d.one_of(ending)


def render(kind: str, mention: str, surrogate: str) -> str:
    """The surrogate in the format of the mention."""
    if kind in ("phone", "card"):
        digits = iter(re.sub(r"\D", "", surrogate))
        return "".join([*(next(digits, c) if c.isdigit() else c for c in mention), *digits])
    if kind == "email":
        return surrogate.upper() if mention.isupper() else surrogate
    if ":" in kind:
        return surrogate.upper() if mention.isupper() and len(mention) > 1 else surrogate[0].upper() + surrogate[1:]
    return surrogate


def with_mentions(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with the entities found in each text."""
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.ArrayType(MENTION))])
    kind = pa.list_(pa.struct(list(arrow_schema(MENTION))))
    at = docs.columns.index("text")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(MENTION.names, m, strict=True)) for m in find(t)] if t else [] for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, column])

    return docs.mapInArrow(look, schema)


def draw_all(entities: DataFrame, key: bytes) -> DataFrame:
    """(type, value, attempt) with their surrogates."""
    schema = arrow_schema(DRAWN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, values, attempts = (c.to_pylist() for c in batch.columns)
            drawn = [draw(key, k, v, a) for k, v, a in zip(kinds, values, attempts, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(drawn, pa.string())], schema=schema)

    return entities.select("type", "value", F.col("attempt").cast("int").alias("attempt")).mapInArrow(run, DRAWN)


def assign(entities: DataFrame, key: bytes = KEY) -> DataFrame:
    """A surrogate for each distinct (type, value): no two the same within a type, none that occurs as a value of the type.

    Given names of either gender and script share one space, as do family names. Who came first keeps a surrogate: fewest attempts,
    then the lesser value.
    """
    family = F.substring_index("type", ":", 1)
    values = saved(entities.withColumn("attempt", F.lit(0)), "entities")
    drawn = draw_all(values, key)
    while True:  # the space of a surrogate grows with its attempts
        first = Window.partitionBy(family, "surrogate").orderBy("attempt", "type", "value")  # as many rows as entities that collide
        taken = values.select(family.alias("family"), F.col("value").alias("surrogate")).distinct().withColumn("occurs", F.lit(True))
        ranked = drawn.withColumn("family", family).withColumn("place", F.row_number().over(first)).join(taken, ["family", "surrogate"], "left")
        judged = saved(ranked.select("type", "value", "attempt", "surrogate", (F.col("occurs").isNull() & (F.col("place") == 1)).alias("good")), "surrogates")
        if judged.where("NOT good").isEmpty():
            return judged.select("type", "value", "surrogate")
        again = draw_all(judged.where("NOT good").withColumn("attempt", F.col("attempt") + 1), key)
        drawn = judged.where("good").select(*DRAWN.names).unionByName(again)


def replace(docs: DataFrame, mentions: str, plan: str, schema: T.StructType) -> DataFrame:
    text, found, given = (docs.columns.index(c) for c in ("text", mentions, plan))
    wanted = [docs.columns.index(c) for c in schema.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, spans, drawn in zip(*(batch.column(c).to_pylist() for c in (text, found, given)), strict=True):
                known = {(p["type"], p["value"]): p["surrogate"] for p in drawn}
                parts, at = [], 0
                for m in spans:
                    parts += [t[at : m["start"]], render(m["type"], t[m["start"] : m["stop"]], known[m["type"], m["value"]])]
                    at = m["stop"]
                out.append("".join([*parts, t[at:]]))
            columns = [pa.array(out, pa.string()) if i == text else batch.column(i) for i in wanted]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def surrogate_texts(docs: DataFrame, key: bytes = KEY, counts: str | None = None) -> DataFrame:
    """``docs`` with every entity in ``text`` replaced; ``counts`` names a further column for the number of mentions."""
    mentions, digest, plan, match = (fresh(docs, c) for c in ("_mentions", "_digest", "_plan", "_match"))
    found = with_mentions(docs, mentions)
    if counts:
        found = found.withColumn(counts, F.size(mentions).cast("bigint"))
    kept = found.drop(mentions).columns
    held = saved(found.where(F.size(mentions) > 0).withColumn(digest, F.md5("text")), "held")
    pairs = held.select(F.col(digest).alias("digest"), F.explode(mentions).alias("m")).select("digest", "m.type", "m.value").distinct()
    pairs = saved(pairs, "mentions")
    chosen = assign(pairs.select("type", "value").distinct(), key)
    # one text's own entities
    plans = pairs.join(chosen, ["type", "value"]).groupBy("digest").agg(F.collect_list(F.struct("type", "value", "surrogate")).alias(plan))
    joined = held.join(plans.withColumnRenamed("digest", match), F.col(digest) == F.col(match))
    changed = replace(joined, mentions, plan, found.select(*kept).schema)
    return found.where(F.size(mentions) == 0).select(*kept).unionByName(changed)
