"""Surrogates for personal data, on built-in expressions (operator 2).

E-mail addresses, IP addresses, card and telephone numbers, secrets and names
after a form of address are found by pattern. Each distinct entity gets one
surrogate, derived from a keyed hash: digits for digits, letters for letters of
the same script and case, the separators as they are; a card number keeps its
first digit and a valid check digit, an IPv4 address stays one, a name keeps
the gender of its form of address and its script, and the same surname gets the
same surrogate after any form of address.

Collision check: a surrogate that two entities share, or that is itself an
entity of the corpus, is given up by all but the first (by text) and derived
anew with the next attempt, until none is left; from the fifth attempt on it
grows, so that this ends where a form has few texts. Equal entities therefore stay
equal and different ones different throughout the corpus.

Scale: surrogates are worked out once for each distinct entity, replaced
mentions go back to their documents by their position in them; texts without a
hint of an entity are not shuffled at all.

Defined cases: a null text stays null, an empty one empty; a secret has a letter
or digit, so that a row of underscores is none; entities are matched
in whole texts of any length; ids need not be distinct, and a null id is an id
like any other; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticklake.llm.common import cut, table

# Patterns of the entities, in order of precedence.
_LETTER = r"[\p{L}\p{M}'’-]"
TITLES_M = r"(?:Mr|Herrn?|Monsieur|Señor|Sr|Господин|Κύριος)"
TITLES_F = r"(?:Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Госпожа|Κυρία)"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?![0-9]|\.[0-9])",
    "secret": r"(?=[A-Za-z0-9_+/-]{16})(?=[_+/-]*+[A-Za-z0-9])(?<=(?:token|secret|password|api_key|apikey) ?[=:] ?[\"']?)[A-Za-z0-9_+/-]{16,}",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])|(?<![0-9-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "name": rf"(?<![\p{{L}}]){TITLES_M}\.? \p{{Lu}}{_LETTER}+(?: \p{{Lu}}{_LETTER}+)?|(?<![\p{{L}}]){TITLES_F}\.? \p{{Lu}}{_LETTER}+(?: \p{{Lu}}{_LETTER}+)?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# What a text with an entity has in any case; far cheaper to look for, as most characters begin none of it.
# A telephone number has a '+' and a digit or three digits in a row, a card number thirteen digits with at most one separator between.
HINT = (r"(?=[@0-9+tspaMHFSГΚ])(?:@|[0-9]\.[0-9]|[0-9]{3}|\+[0-9]|[0-9](?:[ -]?[0-9]){12}|token|secret|password|api_?key|"
        rf"(?:{TITLES_M}|{TITLES_F})\.? \p{{Lu}})")
# Syllables of made-up names by script, and how given names of either gender end.
SYLLABLES = {"latin": "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo zu".split(),
             "cyrillic": "ба ве ги до жу за ки ле мо ну па ре си то фу ха чи шо ля ню".split(),
             "greek": "βα γε δι ζο θυ κα λε μι νο πυ ρα σε τι φο χυ ψα βε γι δο ζα".split()}
ENDINGS = {"latin": ("n", "lla"), "cyrillic": ("н", "на"), "greek": ("ς", "να")}


# Attempts that keep the length of a surrogate; later ones make it longer, as short texts have few others of their form.
_SAME_LENGTH = 4


def _kind(mention: Column) -> Column:
    out = F.when(mention.rlike(f"^(?:{PATTERNS['email']})$"), "email").when(mention.rlike(f"^(?:{PATTERNS['ip']})$"), "ip")
    out = out.when(mention.rlike(r"^[0-9]([ -]?[0-9]){12,18}$"), "card").when(mention.rlike(r"^[0-9+(][0-9 ().-]+$"), "phone")
    return out.when(mention.rlike(f"^(?:{PATTERNS['name']})$"), "name").otherwise("secret")


def _pieces(mention: Column) -> Column:
    """What of a mention gets a surrogate: (kind, text); of names each part for itself."""
    gender = F.when(mention.rlike(f"^{TITLES_F}"), "f").otherwise("m")
    parts = F.slice(F.split(mention, " "), 2, F.size(F.split(mention, " ")) - 1)
    named = F.transform(parts, lambda n, i: F.struct(
        F.when(i == F.size(parts) - 1, F.lit("surname")).otherwise(F.concat(F.lit("given_"), gender)).alias("kind"), n.alias("text")))
    return F.when(_kind(mention) == "name", named).otherwise(F.array(F.struct(_kind(mention).alias("kind"), mention.alias("text"))))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, also where it is used within a loop over an array."""
    return F.transform(F.array(value), use)[0]


def _digits(salt: list, n: int) -> Column:
    """``n`` hash values as an array of small integers."""
    hexes = F.concat(*[F.sha2(F.concat_ws("|", *salt, F.lit(str(i))), 256) for i in range(n)])
    return _let(hexes, lambda h: F.transform(
        F.sequence(F.lit(0), F.lit(16 * n - 1)), lambda i: F.conv(F.substring(h, i * 4 + 1, F.lit(4)), 16, 10).cast("int")))


def _like(text: Column, hashes: Column) -> Column:
    """Each digit and letter replaced by one of its own class."""
    pick = lambda chars, i: F.substring(F.lit(chars), F.get(hashes, i % F.size(hashes)) % len(chars) + 1, F.lit(1))
    classes = [("[0-9]", "0123456789"), ("[a-z]", "abcdefghijklmnopqrstuvwxyz"), ("[A-Z]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
               ("[а-яё]", "абвгдежзиклмнопрстуфхцчшэюя"), ("[А-ЯЁ]", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ")]

    def one(c, i):
        out = F
        for pattern, chars in classes:
            out = out.when(c.rlike(f"^{pattern}$"), pick(chars, i))
        return out.otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _check_digit(body: Column) -> Column:
    """The digit that makes a card number valid (every second digit doubled, from the right)."""
    total = F.aggregate(F.sequence(F.lit(1), F.length(body)), F.lit(0), lambda s, i: s + F.transform(
        F.array(F.substring(body, F.length(body) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)), lambda x: F.floor(x / 10).cast("int") + x % 10)[0])
    return ((10 - total % 10) % 10).cast("string")


def _nth(words: list[str]):
    return lambda x: F.get(F.array(*[F.lit(w) for w in words]), x % len(words))


def _card(text: Column, hashes: Column) -> Column:
    """Another number with a valid check digit, in the groups of the original."""
    plain = F.translate(text, " -", "")
    body = F.concat(F.substring(plain, 1, 1), F.substring(_like(plain, hashes), F.lit(2), F.length(plain) - 2))

    def grouped(number):  # digit j of the number for its j-th digit
        return F.array_join(F.transform(F.split(text, ""), lambda c, i: F.when(c.rlike("^[0-9]$"), F.substring(
            number, F.length(F.translate(F.substring(text, F.lit(1), i + 1), " -", "")), F.lit(1))).otherwise(c)), "")

    return _let(_let(body, lambda b: F.concat(b, _check_digit(b))), grouped)


def _name(kind: Column, text: Column, attempt: Column, hashes: Column) -> Column:
    """A made-up name of the same script, its given names with an ending of their gender."""
    names = F.lit("")
    for script, syllables in reversed(SYLLABLES.items()):
        parts = F.transform(F.slice(hashes, 1, attempt + 3), _nth(syllables))
        end = F.when(kind == "given_f", ENDINGS[script][1]).when(kind == "given_m", ENDINGS[script][0]).otherwise("")
        word = F.initcap(F.concat(F.array_join(parts, ""), end))
        own = {"latin": r"\p{IsLatin}", "cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}[script]
        names = F.when(text.rlike(own), F.when((F.upper(text) == text) & (F.length(text) > 1), F.upper(word)).otherwise(word)).otherwise(names)
    # a name in another script: its letters stand in another order
    return F.when(names == "", F.concat(F.reverse(text), F.repeat(F.substring(text, 1, 1), attempt + 1))).otherwise(names)


def surrogate(kind: Column, text: Column, attempt: Column, key: str) -> Column:
    """The replacement of an entity; another one for each attempt.

    Texts with no other form of their own, and those whose forms run out, get a keyed token appended.
    """
    longer = F.greatest(attempt - (_SAME_LENGTH - 1), F.when(text.rlike("[A-Za-z0-9]"), 0).otherwise(8))
    token = F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("token"), kind, text, attempt.cast("string")), 256), F.lit(1), longer)
    # an address: the local part of its own, the domain alike for all of a domain, its last label as it is
    domain, local = F.substring_index(text, "@", -1), F.substring_index(text, "@", 1)
    site, top = F.regexp_extract(domain, r"^(.*)\.[^.]*$", 1), F.substring_index(domain, ".", -1)
    country = F.regexp_extract(text, r"^(\+[0-9]{1,3})(?=[ (.-])", 1)

    def of(h):
        at = lambda i: F.get(h, F.lit(i))
        new_site = _let(_digits([F.lit(key), F.lit("domain"), F.lower(domain)], 1), lambda d: _like(site, d))
        email = F.concat(_like(local, h), token, F.lit("@"), new_site, F.lit("."), top)
        ip = F.concat_ws(".", (at(0) % 223 + 1).cast("string"), *[(at(i) % 254 + 1).cast("string") for i in (1, 2, 3)])
        phone = F.concat(country, _like(F.substring(text, F.length(country) + 1, F.length(text)), h), F.translate(token, "abcdef", "012345"))
        return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", _card(text, h)).when(kind == "phone", phone)
                .when(kind == "secret", F.concat(_like(text, h), token)).otherwise(_name(kind, text, attempt, h)))

    return _let(_digits([F.lit(key), kind, text, attempt.cast("string")], 2), of)


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, text, surrogate) for distinct ``entities`` (kind, text): no surrogate twice, none an entity itself."""
    kind, text = F.col("kind"), F.col("text")
    now = cut(entities.select("kind", "text", F.lit(0).alias("attempt")).distinct().withColumn("surrogate", surrogate(kind, text, F.col("attempt"), key)))
    real = now.select("kind", F.col("text").alias("surrogate"), F.lit(True).alias("real"))
    while True:
        first = Window.partitionBy("kind", "surrogate").orderBy("attempt", "text")
        marked = now.withColumn("rank", F.row_number().over(first)).join(real, ["kind", "surrogate"], "left")
        again = cut(marked.filter("rank > 1 or real").select("kind", "text", (F.col("attempt") + 1).alias("attempt")))
        if again.isEmpty():
            return now.select("kind", "text", "surrogate")
        moved = again.withColumn("surrogate", surrogate(kind, text, F.col("attempt"), key))
        now = cut(now.join(again.select("kind", "text"), ["kind", "text"], "left_anti").unionByName(moved))


def mention_table(mentions: DataFrame, key: str) -> DataFrame:
    """(mention, new) for distinct ``mentions`` (mention)."""
    parts = mentions.select("mention", F.posexplode(_pieces(F.col("mention"))).alias("at", "p")).select("mention", "at", "p.kind", "p.text")
    new = (parts.join(surrogate_table(parts.select("kind", "text"), key), ["kind", "text"]).groupBy("mention")
           .agg(F.array_sort(F.collect_list(F.struct("at", "kind", "surrogate"))).alias("new")))
    joined = F.array_join(F.col("new.surrogate"), " ")
    is_name = F.col("new")[0]["kind"].isin("surname", "given_m", "given_f")
    return new.select("mention", F.when(is_name, F.concat_ws(" ", F.substring_index("mention", " ", 1), joined)).otherwise(joined).alias("new"))


def replace_entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = "surrogate-key") -> DataFrame:
    """(row, n_entities): ``docs`` as a struct with the entities of its text replaced."""
    text = F.col(f"row.{text_col}")
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    hinted = F.coalesce(text.rlike(HINT), F.lit(False))
    doc = F.sha2(F.concat_ws("|", F.col(f"row.{id_col}").cast("string"), text), 256).alias("doc")
    plain = rows.filter(~hinted).select("row", F.lit(0).cast("long").alias("n_entities"))
    found = cut(rows.filter(hinted).select(doc, F.posexplode(F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(1))).alias("at", "mention")))
    news = mention_table(found.select("mention").distinct(), key)
    by_doc = found.join(news, "mention").groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("at", "new"))).alias("news"))
    joined = rows.filter(hinted).select("row", doc).join(by_doc, "doc", "left")
    between = F.split(text, ANY, -1)
    whole = F.array_join(F.zip_with(between, F.col("news.new"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = F.col("row").withField(text_col, F.when(F.col("news").isNotNull(), whole).otherwise(text))
    return plain.unionByName(joined.select(changed.alias("row"), F.coalesce(F.size("news"), F.lit(0)).cast("long").alias("n_entities")))


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = replace_entities(table(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select("row.doc_id", "n_entities", "row.text")
