"""Private data replaced by surrogates: e-mail addresses, phone and card numbers, IP addresses, secrets, names.

Entities are found by one pattern and brought to a canonical form; every distinct (type, form) gets a keyed surrogate
of its own type. Surrogates that clash, with each other or with an entity that occurs, are drawn again by later
attempts until none does, so different entities stay different and one entity has one surrogate everywhere; in the text
it takes on the format of the place: separators, case, prefixes. DataFrame functions throughout. Only texts
with entities are joined with their surrogates; all others pass unchanged in the same scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import whole, written

#: Attempts that keep the length of what they replace, and attempts altogether.
EQUALLY_LONG, ATTEMPTS = 4, 40
TYPES = ("email", "secret", "ip", "phone", "card", "name")
_TITLES = {
    "m": "Mr Herr Monsieur Señor Signor Sr Don Господин",
    "f": "Mrs Ms Miss Frau Madame Mme Mlle Señora Señorita Signora Sra Doña Госпожа",
    "x": "Dr Prof Doctor Professor Mx",
}
#: Invented and common given names by gender and script, and family names by script.
GIVEN = {
    "m": {"latin": "Albert Bruno Carlos David Emil Felix Gustav Henri Igor Jonas Karl Luis Martin Nils Oscar Pablo Rafael Stefan Thomas Victor".split(),
          "cyrillic": "Алексей Борис Виктор Глеб Денис Егор Иван Кирилл Леонид Максим".split()},
    "f": {"latin": "Alice Berta Clara Diana Elena Frida Greta Helena Irene Julia Karin Laura Maria Nina Olivia Paula Rosa Sofia Teresa Vera".split(),
          "cyrillic": "Алина Валерия Галина Дарья Елена Жанна Ирина Ксения Лариса Марина".split()},
    "x": {"latin": "Alex Andrea Charlie Dominique Eden Jules Kim Lou Morgan Noel Quinn Robin Sasha Sidney Taylor".split(),
          "cyrillic": "Женя Саша Валя Шура Слава".split()},
}
FAMILY = {
    "latin": "Abbott Becker Costa Dupont Engel Ferrer Girard Hansen Iglesias Jensen Keller Lambert Moreau Navarro Ortega Petit Quint Roth Serrano Thorne Ulrich Vidal Weber Young Zeller".split(),
    "cyrillic": "Абрамов Беляев Волков Громов Дроздов Ершов Жуков Зимин Котов Лебедев".split(),
}
# The host's labels are a repeated group, by which the matcher goes deeper: see the README on hosts of thousands of labels.
_EMAIL = r"(?<![\w.+-])[\w+-][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_SECRET = r"(?<=[\"'`=: ])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64}|(?:sk|pk|ghp|gho|xox[abp])[-_][A-Za-z0-9_-]{16,64}|AKIA[0-9A-Z]{16})(?![0-9A-Za-z])"
_IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"
_PHONE = r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\w-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"
_CARD = r"(?<![\w.-])\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}(?!\w)"
_NAME = r"(?<!\p{L})(?:" + "|".join(t for v in _TITLES.values() for t in v.split()) + r")\.? \p{Lu}[\p{L}'’-]+(?: \p{Lu}[\p{L}'’-]+)?"
PATTERN = "|".join((_EMAIL, _SECRET, _IP, _PHONE, _CARD, _NAME))


def entity_type(found: Column) -> Column:
    """The type of a piece of text that the pattern has found."""
    return (
        F.when(found.contains("@"), "email")
        .when(found.rlike(r"^(?:[0-9a-f]{32,64}|[0-9A-F]{32,64}|(?:sk|pk|ghp|gho|xox[abp])[-_].*|AKIA.*)$") & ~found.rlike(r"^\p{L}+\.? "), "secret")
        .when(found.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "ip")
        .when(found.rlike(r"^\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}$"), "card")
        .when(found.rlike(r"^[+(\d]"), "phone")
        .otherwise("name")
    )


def canonical(kind: Column, found: Column) -> Column:
    """One form for all spellings of an entity: digits alone, lower case, names without their title."""
    return (
        F.when(kind.isin("phone", "card"), F.regexp_replace(found, r"\D", ""))
        .when((kind == "email") | ((kind == "secret") & found.rlike("^[0-9A-Fa-f]+$")), F.lower(found))
        .when(kind == "name", F.lower(F.regexp_replace(found, r"^\p{L}+\.? ", "")))
        .otherwise(found)
    )


def _gender(found: Column) -> Column:
    title = F.regexp_extract(found, r"^\p{L}+", 0)
    return F.when(title.isin(*_TITLES["m"].split()), "m").when(title.isin(*_TITLES["f"].split()), "f").otherwise("x")


def _number(digest: Column, place: int | Column, modulus: int) -> Column:
    """A number below modulus from the hex digest, by place (0 to 56)."""
    start = place if isinstance(place, Column) else F.lit(place)
    return F.pmod(F.conv(F.substring(digest, (start + F.lit(1)).cast("int"), F.lit(8)), 16, 10).cast("long"), F.lit(modulus)).cast("int")


def _letters(digest: Column, form: Column, first: int = 0) -> Column:
    """The form with digits and Latin letters replaced by others, all else kept; the leading digit of a number not by 0."""
    chars = F.filter(F.split(form, ""), lambda c: c != "")
    hexa = F.array(*[F.lit(c) for c in "0123456789"])
    abc = F.array(*[F.lit(c) for c in "abcdefghijklmnopqrstuvwxyz"])
    upper = F.array(*[F.lit(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"])

    def one(c, i):
        # A further digest for each character, so that long forms do not repeat.
        n = F.pmod(F.xxhash64(digest, i), F.lit(1 << 30)).cast("int")
        return (
            F.when(c.rlike("[0-9]"), F.get(hexa, F.when((i == 0) & (c != "0"), F.lit(1) + n % F.lit(9)).otherwise(n % F.lit(10))))
            .when(c.rlike("[a-z]"), F.get(abc, n % F.lit(26)))
            .when(c.rlike("[A-Z]"), F.get(upper, n % F.lit(26)))
            .when(c.rlike(r"\p{L}"), F.get(abc, n % F.lit(26)))
            .otherwise(c)
        )

    return F.array_join(F.transform(chars, one), "")


def _hexed(digest: Column, form: Column) -> Column:
    chars = F.filter(F.split(form, ""), lambda c: c != "")
    every = F.array(*[F.lit(c) for c in "0123456789abcdef"])
    return F.array_join(F.transform(chars, lambda c, i: F.get(every, F.pmod(F.xxhash64(digest, i), F.lit(16)).cast("int"))), "")


def _pick(words: list[str], n: Column) -> Column:
    return F.get(F.array(*[F.lit(w.lower()) for w in words]), n)


def surrogate(key: str, kind: Column, form: Column, gender: Column, attempt: int) -> Column:
    """The keyed surrogate of a canonical form, of the same type, length of numbers, gender and script. Attempts after the first
    few make local parts and numbers longer, as all short ones may be taken."""
    longer = max(0, attempt - EQUALLY_LONG + 1) * 2
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, form, F.lit(str(attempt))), 256)
    local = F.concat(F.substring_index(form, "@", 1), F.lit("a" * longer))
    mail = F.concat(_letters(digest, local), F.lit("@"), F.substring_index(form, "@", -1))
    address = F.concat_ws(".", *[(F.lit(1) + _number(digest, 8 * i, 254)).cast("string") for i in range(4)])
    script = F.when(form.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    family, given = F.lit(None), F.lit(None)
    for s in ("latin", "cyrillic"):
        family = F.when(script == s, _pick(FAMILY[s], _number(digest, 0, len(FAMILY[s])))).otherwise(family)
        for g in GIVEN:
            given = F.when((script == s) & (gender == g), _pick(GIVEN[g][s], _number(digest, 16, len(GIVEN[g][s])))).otherwise(given)
    # Later attempts add an initial, so that names never run out: the lists are short, the entities are not.
    tail = F.concat(F.lit("-"), _letters(digest, F.lit("aaaaaa"))) if attempt else F.lit("")
    name = F.when(form.contains(" "), F.concat_ws(" ", given, F.concat(family, tail))).otherwise(F.concat(family, tail))
    # The country code of a phone number and the kind of a card stay, as do a secret's prefix and an address's host.
    number = F.concat(F.substring(form, 1, 1), _letters(digest, F.concat(F.expr("substring(_form, 2)"), F.lit("0" * longer))))
    return (
        F.when(kind == "email", mail)
        .when(kind == "ip", address)
        .when(kind.isin("phone", "card"), number)
        .when((kind == "secret") & form.rlike("^[0-9a-f]+$"), _hexed(digest, form))
        .when(kind == "secret", F.concat(F.substring(form, 1, 4), _letters(digest, F.expr("substring(_form, 5)"))))
        .otherwise(name)
    )


def formatted(kind: Column, found: Column, replacement: Column) -> Column:
    """The surrogate in the format of what it replaces."""
    chars = F.filter(F.split(found, ""), lambda c: c != "")
    digits = F.array_join(
        F.transform(
            chars,
            lambda c, i: F.when(c.rlike("[0-9]"), F.substring(replacement, F.length(F.regexp_replace(F.array_join(F.slice(chars, F.lit(1), i + F.lit(1)), ""), r"\D", "")), F.lit(1))).otherwise(c),
        ),
        "",
    )
    # A number that had to be longer goes on behind the place's last digit.
    digits = F.concat(digits, F.when(kind.isin("phone", "card"), F.substring(replacement, F.length(F.regexp_replace(found, r"\D", "")) + F.lit(1), F.lit(64))).otherwise(""))
    title = F.regexp_extract(found, r"^\p{L}+\.? ", 0)
    rest = F.regexp_replace(found, r"^\p{L}+\.? ", "")
    name = F.concat(title, F.when(F.upper(rest) == rest, F.upper(replacement)).otherwise(F.initcap(replacement)))
    return (
        F.when(kind.isin("phone", "card"), digits)
        .when(kind.isin("email", "secret") & (F.upper(found) == found) & (F.lower(found) != found), F.upper(replacement))
        .when(kind == "name", name)
        .otherwise(replacement)
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(_kind, _form, _surrogate) for distinct (_kind, _form, _gender): no two the same, none an entity itself.

    Of those that clash the smallest form keeps its surrogate, unless it is the form of another entity; the others
    are drawn again. Each attempt handles fewer; what is settled never changes.
    """
    todo = written(entities.groupBy("_kind", "_form").agg(F.min("_gender").alias("_gender")), "op3-entities")
    forms = todo.select("_kind", F.col("_form").alias("_surrogate"))
    settled, attempt = None, 0
    while True:
        drawn = todo.withColumn("_surrogate", surrogate(key, F.col("_kind"), F.col("_form"), F.col("_gender"), attempt))
        free = drawn.join(forms, ["_kind", "_surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("_kind", "_surrogate"), ["_kind", "_surrogate"], "left_anti")
        good = free.groupBy("_kind", "_surrogate").agg(F.min("_form").alias("_form"))
        good = written(good.select("_kind", "_form", "_surrogate"), "op3-good")
        settled = good if settled is None else settled.unionByName(good)
        todo = written(todo.join(good, ["_kind", "_form"], "left_anti"), "op3-todo")
        if todo.isEmpty():
            return settled
        attempt += 1
        if attempt == ATTEMPTS:
            raise RuntimeError(f"No free surrogates were found for some entities in {ATTEMPTS} attempts")


def replace_private_data(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """docs with the text's entities replaced, and _entities: an array of (kind, count), empty where there are none.

    Null text becomes empty; texts without entities are unchanged. Repeated rows are replaced alike. All
    columns stay (names beginning with an underscore are the operator's own). key is the secret of the
    surrogates: the same key gives the same ones for the same entities of a table.
    """
    whole_text = whole(F.col(text))
    has = whole_text.rlike(PATTERN)
    plain = docs.where(~has).withColumn(text, whole_text).withColumn("_entities", F.expr("CAST(array() AS ARRAY<STRUCT<kind: STRING, count: INT>>)"))
    found = written(
        docs.where(has).withColumn(text, whole_text).withColumn("_row", F.monotonically_increasing_id()).withColumn("_found", F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))),
        "op3-found",
    )
    each = found.select("_row", F.posexplode("_found").alias("_at", "_piece")).withColumn("_kind", entity_type(F.col("_piece")))
    each = each.select("_row", "_at", "_piece", "_kind", canonical(F.col("_kind"), F.col("_piece")).alias("_form"), F.when(F.col("_kind") == "name", _gender(F.col("_piece"))).alias("_gender"))
    # Joined to one row per entity; a very frequent entity's rows are split by adaptive execution.
    made = each.join(surrogates(each, key), ["_kind", "_form"]).select(
        "_row", F.struct("_at", formatted(F.col("_kind"), F.col("_piece"), F.col("_surrogate")).alias("new"), F.col("_kind").alias("kind")).alias("_one")
    )
    of_row = made.groupBy("_row").agg(F.sort_array(F.collect_list("_one")).alias("_new"))
    parts = F.split(F.col(text), PATTERN, -1)
    joined = F.array_join(F.zip_with(parts, "_new", lambda a, b: F.concat(a, F.coalesce(b["new"], F.lit("")))), "")

    def of_kind(kind: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.size(F.filter("_new", lambda x: x["kind"] == kind)).alias("count"))

    counts = F.filter(F.array(*[of_kind(t) for t in TYPES]), lambda x: x["count"] > 0)
    changed = found.join(of_row, "_row").withColumn("_entities", counts).withColumn(text, joined).select(*plain.columns)
    return plain.unionByName(changed)
