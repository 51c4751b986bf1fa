"""Private data replaced by surrogates, in DataFrame functions only.

Found are e-mail addresses, telephone, valid card and social security numbers, IBANs, IPv4 addresses,
access keys, labelled secrets, and names of people after a title or with a known given name. Each
is made of atoms (a mailbox and a domain; a given name and a surname; a value after its label), and an atom
gets a surrogate of its kind from a keyed hash of its canonical form: letters for letters in their
case, digits for digits, valid check digits for valid ones, given names of the same gender and names of
the same script. So an atom has the same surrogate wherever it occurs. The hash knows a name and its script, not
its gender: that only chooses the names to draw from. Titles and known given names tell it, and where they differ
from one occurrence to another, or are silent in some, what most tell holds for all; the first of f and m on a tie.

Before texts are rewritten, the distinct atoms of all documents are checked: no two may share a
surrogate, and none may be another atom of the corpus. An atom that loses its surrogate tries the
next one, until all are settled; names and mailboxes get longer as they run out. Only these exceptions are
looked up when texts are rewritten, and that is a pass without a shuffle of texts while they are few.

Defined cases: a null or empty text, and one without findings, stays as it is; null ids are kept;
repeated rows are rewritten alike; empty tables give no rows; other columns stay as they are, but that a
column ``n_chars`` is brought up to date where a text changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import table, written

KEY = "a key of your own"
MOST_ROUNDS = 60
MOST_INLINE = 2000

# Titles by gender, and names by gender and script.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "господин", "Господин", "г-н"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "госпожа", "Госпожа", "г-жа"],
    "x": ["Dr", "Prof"],
}
NAMES = {
    "given_f_latin": "Anna Maria Laura Julia Sophie Emma Elena Clara Marie Sarah Lucia Carmen Helen Ingrid Paula Nina Alice Diana Irene Martha Camille Claire Amélie Élodie Sofía".split(),
    "given_m_latin": "Thomas Peter Daniel Martin Paul David Lucas Felix Simon Carlos Pablo Miguel Pierre Louis Karl Hans Stefan James Robert Henry Édouard José Andrés Jürgen Günter".split(),
    "given_f_cyrillic": "Анна Мария Елена Ольга Татьяна Наталья Ирина Светлана Екатерина Юлия".split(),
    "given_m_cyrillic": "Иван Пётр Сергей Андрей Алексей Дмитрий Николай Михаил Павел Виктор".split(),
    "surname_x_latin": "Keller Bauer Weber Vogel Brandt Lindner Moreau Lambert Girard Fontaine Navarro Herrera Campos Vidal Serrano Parker Bennett Foster Hughes Palmer Turner Coleman Barnes Hayes Murray".split(),
    "surname_f_cyrillic": "Смирнова Кузнецова Попова Волкова Соколова Лебедева Козлова Новикова Морозова Павлова".split(),
    "surname_m_cyrillic": "Смирнов Кузнецов Попов Волков Соколов Лебедев Козлов Новиков Морозов Павлов".split(),
}
NAMES["given_x_latin"] = "Alex Robin Kim Sascha Dominique Claude Andrea Noa Sam Charlie".split()
NAMES["given_x_cyrillic"] = "Саша Женя Валя Слава Шура".split()
NAMES["surname_x_cyrillic"] = "Шевченко Бондаренко Ткаченко Кравченко Коваленко Седых Белых Черных".split()

_TITLE = "(?:" + "|".join(t for titles in TITLES.values() for t in titles) + ")\\.?"
_GIVEN = "(?:" + "|".join(n for kind in NAMES if kind.startswith("given") for n in NAMES[kind]) + ")"
_NAME = "\\p{Lu}[\\p{L}'’-]{1,40}"
_OCTET = "(?:25[0-5]|2[0-4]\\d|1\\d\\d|[1-9]?\\d)"
_LABEL = "(?i:password|passwd|pwd|token|secret|api[_-]?key)[\"']?[ \\t]{0,2}[=:]"
# A labelled value: to its closing quote, or to the next white space without the signs that end a clause.
_ALNUM = "[\\p{L}\\p{N}]"
# The closing quote is the first that an even number of backslashes precedes, and an escape counts as one sign.
_QUOTED = "|".join(f"{q}(?=(?:\\\\.|[^{q}\\\\\\n]){{6}})[^\\n]*?(?<!\\\\)(?:\\\\\\\\)*+{q}" for q in "\"'")
_BARE = f"[\"']?(?=\\S*{_ALNUM})\\S{{6,}}(?<![,.;:)\\]}}>\"'])"
_EMAIL = "(?<![._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\\.){1,8}[A-Za-z]{2,24}(?![A-Za-z])"
_IP = f"(?:{_OCTET}\\.){{3}}{_OCTET}(?!\\w|\\.\\d)"
_SSN = "\\d{3}-\\d{2}-\\d{4}(?![\\w-])"
_LOCAL = "\\d{3}[.-]\\d{3}[.-]\\d{4}(?![\\w-])"
# Shapes of card numbers by their first four digits; a shape has one separator or none.
_FIRST = "(?:[3-6]\\d{3}|2(?:22[1-9]|2[3-9]\\d|[3-6]\\d\\d|7[01]\\d|720))"
_FOURS = f"{_FIRST}(?: \\d{{4}}){{3}}|{_FIRST}(?:-\\d{{4}}){{3}}"
_SIXES = "3\\d{3}(?: \\d{6} \\d{4,5}|-\\d{6}-\\d{4,5})"
_THREES = "4\\d{3}(?: \\d{3}){3}|4\\d{3}(?:-\\d{3}){3}"
_UNSPACED = f"(?:[3-6]\\d{{12,18}}|{_FIRST}\\d{{12}})"
CARDS = [f"{_UNSPACED}|{_FOURS}|{_SIXES}|{_THREES}", f"{_FIRST}(?: \\d{{4}}){{3}} \\d{{1,3}}|{_FIRST}(?:-\\d{{4}}){{3}}-\\d{{1,3}}"]
# Numbers of four digits after one another are one match, of which cards() takes what is valid. Digits
# grouped in another way are a card as a whole, if no shape starts among them.
_SHAPED = f"(?:{_FOURS}|{_SIXES}|{_THREES}|{_UNSPACED})(?![\\w-])"
_CARD = (
    f"(?=[2-6])(?<![\\w.-])(?:{_FIRST}(?: (?!{_EMAIL})\\d{{4}}){{3,}}(?: (?!{_IP}|{_EMAIL}|{_LOCAL})\\d{{1,3}})?(?![\\w-])"
    f"|{_FIRST}(?:-\\d{{4}}){{3}}-\\d{{1,3}}(?![\\w-])|{_SHAPED}"
    f"|[3-6](?:(?: (?!{_SHAPED}|{_IP}|{_EMAIL}|{_LOCAL}|{_SSN})|-)?\\d){{12,18}}(?![\\w-]))"
)
# Between the groups of a phone number: no other finding starts there. From the third group on, a number
# may be whole, so that a social security or local number is one of its own.
# Groups of four before a card are not part of it.
_NEXT_CARD = (
    f"{_FIRST}(?: \\d{{4}}){{3}}(?:(?: \\d{{4}}){{4}})*+(?! \\d{{4}}(?!\\w))(?![\\w-])"
    f"|(?:{_FIRST}(?:-\\d{{4}}){{3}}|{_SIXES}|{_THREES}|{_UNSPACED})(?![\\w-])"
)
_OTHER = f"{_IP}|{_EMAIL}|{_NEXT_CARD}"
_GROUP = f"(?: (?!{_OTHER})|-(?!{_IP})|\\.)?\\d{{2,4}}"
_LATER = f"(?: (?!{_OTHER}|{_SSN}|{_LOCAL})|-(?!{_IP})|\\.)?\\d{{2,4}}"
_START = "\\+\\d{1,3}[ .-]?(?:\\(\\d{1,4}\\)[ .-]?)?\\d{2,4}"
_ABROAD = f"{_START}{_GROUP}(?:{_LATER}){{0,2}}"
# The digits after the country's number, where all numbers of a country have as many.
_DIGITS = {10: "1|7|44|52|57|90|91|92|98", 9: "27|31|33|34|41|48|61|351|380", 8: "45|47|65|852"}
_WHOLE = "|".join(f"(?<=\\+(?:{of})(?:[ .-]?\\(0\\))?{'[ .()-]{0,2}[0-9]' * n})" for n, of in _DIGITS.items())
# What is found, in the order of precedence, and the kind of a finding by its form. Every
# form starts where no letter or digit is before, and says by a look ahead what it may start with, so
# that most places of a text are passed over at the cost of a look at one or two characters.
FORMS = {
    "email": _EMAIL,
    "secret": "(?=[aApPsStT])" + _LABEL + f"[ \\t]{{0,2}}(?:{_QUOTED}|{_BARE})",
    "access": "AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "iban": "(?=[A-Z]{2}\\d)[A-Z]{2}\\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": f"(?=\\d)(?<![\\w.]){_IP}",
    "ssn": f"(?=\\d)(?<![\\w-]){_SSN}",
    "phone": f"(?=[+(\\d])(?<![\\w+])(?:{_START}(?:[ .-]?\\d{{2,4}}){{1,3}}(?:{_WHOLE})(?!\\w)|{_ABROAD}(?!\\w)"
             f"|\\(\\d{{3}}\\) ?\\d{{3}}[ .-]\\d{{4}}(?!\\w)|(?<![.-]){_LOCAL})",
    "card": _CARD,
    "person": f"(?=[\\p{{Lu}}г])(?<!\\p{{L}})(?:{_TITLE} (?:{_NAME} )?{_NAME}|{_GIVEN} {_NAME})",
}
_CLOSING = "[\"']$"
ANYTHING = "(?<![A-Za-z0-9])(?:" + "|".join(FORMS.values()) + ")"
# A text without these has no findings.
HINT = "[0-9@]|(?<![A-Za-z0-9])(?:AKIA|(?=[aApPsStT])" + _LABEL + f"|(?=[\\p{{Lu}}г])(?<!\\p{{L}})(?:{_TITLE}|{_GIVEN}) \\p{{Lu}})"


def _kind(found: Column) -> Column:
    kind = F.when(found.rlike(f"^(?:{FORMS['secret']})$"), "secret").when(F.contains(found, F.lit("@")), "email")
    for name in ("access", "ip", "ssn", "iban", "card", "phone"):
        kind = kind.when(found.rlike(f"^(?:{FORMS[name]})$"), name)
    return kind.otherwise("person")


def _atom(keep: Column | str, kind: Column | str, value: Column) -> Column:
    text = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(text(keep).alias("keep"), text(kind).alias("kind"), value.alias("value"))


def _person(found: Column) -> Column:
    """Atoms of a name: a title is kept, the last word is a surname, one before it a given name."""
    title = F.regexp_extract(found, f"^({_TITLE} )", 1)
    words = F.split(F.substr(found, F.length(title) + 1), " ")
    of_title = F.lit("x")
    for gender in "mf":
        of_title = F.when(title.rlike("^(?:" + "|".join(TITLES[gender]) + ")\\.? $"), gender).otherwise(of_title)
    given, surname = words[0], F.element_at(words, -1)
    script = F.when(surname.rlike("[\\u0400-\\u04FF]"), "cyrillic").otherwise("latin")
    gender = of_title
    for g in "mf":
        known = [n for s in ("latin", "cyrillic") for n in NAMES[f"given_{g}_{s}"]]
        gender = F.when((F.size(words) > 1) & given.isin(known), g).otherwise(gender)
    of_surname = F.when(script == "latin", "x").otherwise(gender)
    last = lambda keep: _atom(keep, F.concat(F.lit("surname_"), of_surname, F.lit("_"), script), surname)
    first = _atom(title, F.concat(F.lit("given_"), gender, F.lit("_"), script), given)
    return F.when(F.size(words) > 1, F.array(first, last(" "))).otherwise(F.array(last(title)))


def told(found: Column) -> Column:
    """``struct<found, kind, cards>`` of a match: what all that follows asks for, computed once."""
    return _let(_kind(found), lambda kind: F.struct(
        found.alias("found"), kind.alias("kind"), F.when(kind == "card", cards(found)).alias("cards")
    ))


def atoms(match: Column) -> Column:
    """``array<struct<keep, kind, value>>`` of a finding: texts to keep, and the values to replace. The
    keeps and values in order are the finding, but for what :func:`tail` gives."""
    found, kind = match["found"], match["kind"]
    domain = F.regexp_extract(found, "@(.*)\\.[^.]*$", 1)
    label = F.regexp_extract(found, "^([A-Za-z_-]+[\"']?[ \\t]*[=:][ \\t]*[\"']?)", 1)
    country = F.regexp_extract(found, "^(\\+\\d{1,3})", 1)
    rest = lambda keep: F.substr(found, F.length(keep) + 1)
    secret = lambda keep: _atom(keep, "secret", F.regexp_replace(rest(keep), _CLOSING, ""))
    return (
        F.when(kind == "email", F.array(_atom("", "mailbox", F.substring_index(found, "@", 1)), _atom("@", "domain", domain)))
        .when(kind == "secret", F.array(_let(label, secret)))
        .when(kind == "access", F.array(_atom("AKIA", "access", F.substr(found, F.lit(5)))))
        .when(kind == "iban", F.array(_atom(F.substr(found, F.lit(1), F.lit(2)), "iban", F.substr(found, F.lit(3)))))
        .when((kind == "phone") & found.rlike("^\\+\\d{1,3}[ .(-]"), F.array(_let(country, lambda c: _atom(c, "phone", rest(c)))))
        .when(kind == "person", _person(found))
        .when(kind == "card", _card_atoms(found, match["cards"]))
        .otherwise(F.array(_atom("", kind, found)))
    )


def tail(match: Column) -> Column:
    """The end of a finding that comes after its atoms."""
    found, kind = match["found"], match["kind"]
    return (
        F.when(kind == "email", F.regexp_extract(found, "(\\.[^.]*)$", 1))
        .when(kind == "card", F.substr(found, _end(match["cards"]) + 1))
        .when(kind == "secret", F.regexp_extract(found, _CLOSING, 0)).otherwise("")
    )


def canonical(kind: Column, value: Column) -> Column:
    """What makes two values the same: letters in any case, digits however they are grouped."""
    grouped = kind.isin("phone", "card", "iban", "ssn")
    return F.when(kind.isin("secret", "access"), value).when(grouped, F.regexp_replace(F.upper(value), "[^0-9A-Z]", "")).otherwise(F.lower(value))


def base(kind: Column) -> Column:
    """The kind without the gender of a name."""
    return F.regexp_replace(kind, "^(given|surname)_[fmx]_", "$1_")


def _hashed(key: str, kind: Column, name: Column, attempt: Column, block: Column | int) -> Column:
    """128 hex digits of a keyed hash."""
    block = F.lit(block) if isinstance(block, int) else block
    message = F.concat_ws("\x1f", F.lit(key), base(kind), name, attempt.cast("string"), block.cast("string"))
    return F.sha2(F.concat(F.lit(key), F.sha2(message, 256)), 512)


def _number(digits: Column, at: Column, size: int = 4) -> Column:
    """The number at a place of ``digits``, an array of blocks of 128 hex digits."""
    block = F.get(digits, F.floor((at - 1) / 128).cast("int"))
    return F.conv(F.substr(block, ((at - 1) % 128 + 1).cast("int"), F.lit(size)), 16, 10).cast("int")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def surrogate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """The ``attempt``-th surrogate of a value, in the form of the value."""
    name = canonical(kind, value)
    longer = F.when(kind.isin("mailbox", "domain", "secret"), F.repeat(F.lit("q"), F.floor(attempt / 3).cast("int"))).otherwise("")
    blocks = F.sequence(F.lit(0), F.floor((F.length(value) + F.length(longer) - 1) / 32).cast("int"))
    digits = F.transform(blocks, lambda b: _hashed(key, kind, name, attempt, b))
    result = F.when(kind.rlike("^(given|surname)_"), _drawn(kind, digits, attempt)).otherwise(
        _let(digits, lambda d: _mapped(kind, F.concat(value, longer), d))
    )
    shouted = (F.length(value) > 1) & (F.upper(value) == value) & (F.lower(value) != value) & kind.rlike("^(given|surname)_")
    # Named once: written out twice, each use of a surrogate would double what is planned and compiled.
    return _let(result, lambda r: F.when(shouted, F.upper(r)).otherwise(r))


def _drawn(kind: Column, digits: Column, attempt: Column) -> Column:
    """A name of the kind's pool; more names joined from the third attempt on."""
    pools = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for item in NAMES.items() for x in item])
    # A hash has room for 32 draws, more than MOST_ROUNDS can ask for.
    parts = F.sequence(F.lit(0), F.floor(attempt / 3).cast("int"))
    draw = lambda pool, d: F.transform(parts, lambda p: F.element_at(pool, _number(d, p * 4 + 1) % F.size(pool) + 1))
    return F.array_join(_let(F.element_at(pools, kind), lambda pool: _let(digits, lambda d: draw(pool, d))), "-")


def _mapped(kind: Column, form: Column, digits: Column) -> Column:
    """``form`` with its letters and digits replaced by what the hash ``digits`` gives for their places."""
    is_hex = (kind == "secret") & form.rlike("^[0-9a-f]+q*$")
    # Numbers of equal digits must get equal digits however they are grouped: places count digits only.
    grouped = kind.isin("phone", "card", "iban", "ssn")
    upto = lambda i: F.length(F.regexp_replace(F.substr(form, F.lit(1), i), "[^0-9A-Za-z]", ""))

    def one(c: Column, place: Column) -> Column:
        n = _number(digits, place * 4 - 3)
        digit = F.when((kind == "phone") & (place == 1), n % 8 + 50).otherwise(n % 10 + 48)
        return (
            F.when((kind == "card") & (place == 1), c)
            .when(is_hex, F.lower(F.hex(n % 16)))
            .when(c.between("0", "9"), F.char(digit))
            .when(c.between("a", "z"), F.char(n % 26 + 97))
            .when(c.between("A", "Z"), F.char(n % 26 + 65))
            .when((kind == "secret") & c.rlike(_ALNUM), F.char(n % 26 + 97))
            .otherwise(c)
        )

    place = lambda i: F.when(grouped, F.greatest(upto(i), F.lit(1))).otherwise(i)
    chars = F.transform(F.split(form, ""), lambda c, i: one(c, place(i + 1)))
    octets = [_number(digits, F.lit(1)) % 223 + 1, *[_number(digits, F.lit(4 * i + 1)) % 256 for i in (1, 2, 3)]]
    checked = (kind == "card") & _luhn(F.regexp_replace(form, "[^0-9]", ""))
    return F.when(kind == "ip", F.concat_ws(".", *[o.cast("string") for o in octets])).otherwise(
        _let(F.array_join(chars, ""), lambda m: F.when(checked, _with_check(m)).otherwise(m))
    )


def _with_check(number: Column) -> Column:
    """A card number whose last digit makes it valid."""
    start = F.substr(number, F.lit(1), F.length(number) - 1)
    plain = F.regexp_replace(start, "[^0-9]", "")
    return F.concat(start, F.filter(F.array(*[F.lit(str(d)) for d in range(10)]), lambda d: _luhn(F.concat(plain, d)))[0])


def cards(found: Column) -> Column:
    """``array<struct<at, value>>``: the valid cards of a match in the form of a card's, from left to right.

    Where a card of 16 digits and a longer one start at one place, a first digit 6 or 50, 56 to 58 tells the longer.
    """
    valid = lambda number: (number != "") & _luhn(F.regexp_replace(number, "[^0-9]", ""))

    def at(i: Column) -> Column:
        here = F.substr(found, i, F.lit(30))
        short, long = (F.regexp_extract(here, f"^(?:{shape})(?!\\d)", 0) for shape in CARDS)
        both = F.when(here.rlike("^(?:6|5[0678])"), F.array(long, short)).otherwise(F.array(short, long))
        return F.struct(i.alias("at"), F.get(F.filter(both, valid), F.lit(0)).alias("value"))

    begins = lambda i: (i == 1) | F.substr(found, i - 1, F.lit(1)).isin(" ", "-")
    places = F.filter(F.sequence(F.lit(1), F.length(found)), begins)
    all_cards = F.filter(F.transform(places, at), lambda c: c["value"].isNotNull())
    end = lambda chosen: F.coalesce(_end(chosen), F.lit(0))
    none = F.array().cast("array<struct<at:int,value:string>>")
    apart = F.aggregate(all_cards, none, lambda chosen, c: F.when(c["at"] > end(chosen), F.concat(chosen, F.array(c))).otherwise(chosen))
    whole = F.array(F.struct(F.lit(1).alias("at"), found.alias("value")))
    digits = F.length(F.regexp_replace(found, "[^0-9]", ""))
    return _let(apart, lambda a: F.when(F.size(a) > 0, a).when((digits <= 19) & valid(found), whole).otherwise(none))


def _end(chosen: Column) -> Column:
    """The last place of the last card."""
    last = F.get(chosen, F.size(chosen) - 1)
    return last["at"] + F.length(last["value"]) - 1


def _card_atoms(found: Column, chosen: Column) -> Column:
    def one(c: Column, k: Column, chosen: Column) -> Column:
        before = F.coalesce(_end(F.slice(chosen, F.lit(1), k)), F.lit(0))
        return _atom(F.substr(found, before + 1, c["at"] - before - 1), "card", c["value"])

    return F.transform(chosen, lambda c, k: one(c, k, chosen))


def n_private(match: Column) -> Column:
    """The findings in a match: a number in the form of a card's must have a valid check digit, and what is in
    quotes after a label a letter or digit."""
    empty = (match["kind"] == "secret") & match["found"].rlike(f"^{_LABEL}[ \\t]{{0,2}}[\"'](?:(?!{_ALNUM})[^\\n])*+$")
    return F.when(match["kind"] == "card", F.size(match["cards"])).when(empty, 0).otherwise(1)


def is_private(match: Column) -> Column:
    """Whether a match has a finding."""
    return n_private(match) > 0


def matches(text: Column) -> Column:
    """Everything in a text that has the form of private data, in order, as :func:`told` tells it."""
    none = F.array().cast("array<string>")
    return F.transform(F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANYTHING), F.lit(0))).otherwise(none), told)


def findings(text: Column) -> Column:
    return F.filter(matches(text), is_private)


def settle(found: DataFrame, key: str) -> DataFrame:
    """``kind, name, attempt, as_kind`` of the exceptions: atoms whose first surrogate is taken, and names whose
    occurrences tell more than one gender. ``kind`` is without the gender, ``as_kind`` has the one that holds.

    ``found`` has the ``kind, value`` of all atoms. A surrogate belongs to the atom with the fewest
    attempts, then to the smallest; one that is an atom of the corpus itself belongs to none.
    """
    name = canonical(F.col("kind"), F.col("value"))
    told = found.groupBy("kind", name.alias("name")).agg(F.min("value").alias("value"), F.count("*").alias("n"))
    # A name is judged by its smallest form: other forms differ in case or grouping only.
    silent = F.col("kind").rlike("^(given|surname)_x_")
    all_atoms = told.groupBy(base(F.col("kind")).alias("of"), "name").agg(
        F.min("value").alias("value"), F.min(F.struct(silent.alias("silent"), (-F.col("n")).alias("less"), "kind"))["kind"].alias("as_kind"),
        (F.count("*") > 1).alias("differs"),
    )
    all_atoms = written(all_atoms.withColumnRenamed("of", "kind").withColumn("attempt", F.lit(0)), "atoms")
    originals = all_atoms.select("kind", F.col("name").alias("claim"), F.lit(True).alias("original"))
    claim = _let(surrogate(key, F.col("as_kind"), F.col("value"), F.col("attempt")), lambda s: canonical(F.col("kind"), s))
    for _ in range(MOST_ROUNDS):
        # Written, else every use of a claim below, and every test of it for null, has the whole expression of a surrogate.
        claims = written(all_atoms.withColumn("claim", claim), "claims")
        owners = claims.groupBy("kind", "claim").agg(F.min(F.struct("attempt", "name")).alias("owner"))
        judged = claims.join(owners, ["kind", "claim"]).join(originals, ["kind", "claim"], "left")
        lost = F.col("original").isNotNull() | (F.col("owner.name") != F.col("name"))
        judged = written(judged.select("kind", "name", "value", "attempt", "as_kind", "differs", lost.alias("lost")), "judged")
        if judged.where("lost").isEmpty():
            return judged.where("attempt > 0 OR differs").select("kind", "name", "attempt", "as_kind")
        all_atoms = judged.select("kind", "name", "value", (F.col("attempt") + F.col("lost").cast("int")).alias("attempt"), "as_kind", "differs")
    raise ValueError(f"surrogates still collide after {MOST_ROUNDS} rounds")


def _label(kind: Column, name: Column) -> Column:
    return F.concat_ws("\x1f", kind, name)


def replace_private(
    docs: DataFrame, key: str = KEY, doc: str = "doc_id", text: str = "text", found_as: str | None = None, most_inline: int = MOST_INLINE,
) -> DataFrame:
    """``docs`` with private data replaced; ``found_as`` names a column for the number of findings."""
    found = F.explode(findings(F.col(text)))
    every = docs.select(F.col(doc).alias("doc"), found.alias("found")).select("doc", F.explode(atoms(F.col("found"))).alias("atom"))
    every = every.select("doc", "atom.kind", "atom.value")
    exceptions = written(settle(every.select("kind", "value"), key), "exceptions")
    columns = docs.columns
    n = exceptions.count()
    rows = docs
    if not n:
        attempts = None
    elif n <= most_inline:
        pair = F.struct(_label(F.col("kind"), F.col("name")), F.struct("attempt", "as_kind"))
        rows = docs.withColumn("__attempts", exceptions.agg(F.map_from_entries(F.collect_list(pair))).scalar())
        attempts = F.col("__attempts")
    else:
        # Too many to send along: each document gets its own.
        own = every.select("doc", canonical(F.col("kind"), F.col("value")).alias("name"), base(F.col("kind")).alias("kind"))
        own = own.join(exceptions, ["kind", "name"])
        pair = F.struct(_label(F.col("kind"), F.col("name")), F.struct("attempt", "as_kind"))
        own = own.groupBy("doc").agg(F.map_from_entries(F.collect_set(pair)).alias("__attempts")).withColumnRenamed("doc", "__doc")
        rows = docs.join(own, F.col(doc).eqNullSafe(F.col("__doc")), "left")
        attempts = F.col("__attempts")

    def replaced(atom: Column) -> Column:
        kind, value = atom["kind"], atom["value"]
        if attempts is None:
            return F.concat(atom["keep"], surrogate(key, kind, value, F.lit(0)))
        known = F.element_at(attempts, _label(base(kind), canonical(kind, value)))
        chosen = F.coalesce(known, F.struct(F.lit(0).alias("attempt"), kind.alias("as_kind")))
        return _let(chosen, lambda c: F.concat(atom["keep"], surrogate(key, c["as_kind"], value, c["attempt"])))

    rows = rows.withColumn("__found", matches(F.col(text)))
    gaps = F.split(F.col(text), ANYTHING, -1)
    whole = lambda f: F.concat(F.array_join(F.transform(atoms(f), replaced), ""), tail(f))
    new = F.transform("__found", lambda f: F.when(is_private(f), whole(f)).otherwise(f["found"]))
    woven = F.concat(F.array_join(F.zip_with(F.slice(gaps, F.lit(1), F.size("__found")), new, lambda gap, put: F.concat(gap, put)), ""), F.element_at(gaps, -1))
    has = F.exists("__found", is_private)
    rows = rows.withColumn("__woven", F.when(has, woven))
    changed = {text: F.coalesce("__woven", text)}
    if "n_chars" in columns:
        changed["n_chars"] = F.when(has, F.length("__woven").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    picked = [changed[c].alias(c) if c in changed else F.col(c) for c in columns]
    if found_as:
        n = F.aggregate("__found", F.lit(0), lambda total, f: total + n_private(f))
        picked.append(F.coalesce(n, F.lit(0)).alias(found_as))
    return rows.select(*picked)


def op5_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return replace_private(docs, found_as="n_findings")


