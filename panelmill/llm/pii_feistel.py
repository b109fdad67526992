"""Format-preserving pseudonyms for personal data, made of built-in SQL functions only.

One regular expression finds candidates; checks on the value (check digits, ranges, calendar) decide. A valid value is
permuted inside its own format by a keyed Feistel network, so it stays valid, equal values get equal pseudonyms in all
documents, and different ones different pseudonyms. What is between the values is not touched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import texts

ROUNDS = 8
DIGITS = "0123456789"
HEX = "0123456789abcdef"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
WORD = DIGITS + LETTERS

#: The candidates of each kind, in order of precedence. None of them may begin or end inside a longer word or number.
PATTERNS = {
    "secret": r"(?i:\b(?:api[_-]?key|access[_-]?key|secret(?:[_-]?key)?|token|passwd|password|pwd))[\"']?[ \t]{0,3}[=:][ \t]{0,3}[\"']?[A-Za-z0-9_+/=.-]{6,}",
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "card": r"(?<![0-9])(?:[0-9][ -]?){12,18}[0-9](?![0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])"
             r"|(?<![0-9A-Za-z])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
#: Lines without any of these hold no candidate, and no candidate goes over the end of a line.
HINT = "[0-9@=:]|AKIA|ASIA"
NUMBERS = f"^(?:{PATTERNS['card']}|{PATTERNS['iban']})$"
#: Runs of groups in which a card or an account number can stand beside other groups, and one group with what is before it.
CARD_RUN, CARD_GROUP = r"(?<![0-9])[0-9]++(?:[ -][0-9]++)*+", "[ -]?[0-9]+"
IBAN_RUN, IBAN_GROUP = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]*+(?![A-Za-z0-9])(?: [A-Z0-9]++(?![A-Za-z0-9]))*+", " ?[A-Z0-9]+"
#: Usual groupings of cards; they go before others that may pass the check by chance.
CARD_FORM = r"^[ -]?(?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}(?:[ -][0-9]{3})?|3[0-9]{3}[ -][0-9]{6}[ -][0-9]{4,5}|[0-9]{13,19})$"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Days from 1900-01-01 to 2099-12-31, all that the pattern takes, as a product of two numbers for the two halves.
FIRST_DAY, DAY_A, DAY_B = "1900-01-01", 17, 4297


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, as the only element of an array."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _byte(digest: Column, i: Column) -> Column:
    return F.conv(F.substring(digest, 2 * (i % 64) + 1, F.lit(2)), 16, 10).cast("int")


def feistel(value: Column, alphabet: str, key: str, tweak: Column) -> Column:
    """A keyed permutation of the strings over ``alphabet`` that have the length of ``value``.

    Eight rounds over two halves: each adds to one half, symbol by symbol, a keystream that SHA-512 draws from the
    other. Strings of one symbol have nothing to mix with and are shifted by a fixed keyed amount.
    """
    return let(value, lambda v: _feistel(v, alphabet, key, tweak))


def _feistel(value: Column, alphabet: str, key: str, tweak: Column) -> Column:
    base = len(alphabet)

    def add(half: Column, digest: Column) -> Column:
        moved = F.transform(F.split(half, ""), lambda c, i: F.when(c == "", "").otherwise(F.substring(
            F.lit(alphabet), (F.instr(F.lit(alphabet), c) - 1 + _byte(digest, i)) % base + 1, F.lit(1))))
        return F.array_join(moved, "")

    cut = (F.length(value) / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), cut).alias("a"), F.substring(value, cut + 1, F.length(value)).alias("b"))

    def step(s: Column, r: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, r.cast("string"), F.length(value).cast("string"), s["b"]), 512)
        return F.struct(s["b"].alias("a"), let(digest, lambda d: add(s["a"], d)).alias("b"))

    mixed = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["a"], s["b"]))
    shifted = add(value, F.sha2(F.concat_ws("|", F.lit(key), tweak, F.lit("one")), 512))
    return F.when(F.length(value) < 2, shifted).otherwise(mixed)


def number_feistel(value: Column, a: int, b: int, key: str, tweak: str) -> Column:
    """A keyed permutation of 0 .. a * b - 1, with one half modulo ``a`` and the other modulo ``b``."""

    def step(s: Column, r: Column) -> Column:
        draw = lambda half, i: F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), r.cast("string"), F.lit(i), half.cast("string")), 256), 1, 12), 16, 10).cast("bigint")
        return let((s["x"] + draw(s["y"], "a")) % a, lambda left: F.struct(left.alias("x"), ((s["y"] + draw(left, "b")) % b).alias("y")))

    start = F.struct((value / b).cast("bigint").alias("x"), (value % b).cast("bigint").alias("y"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), start, step, lambda s: s["x"] * b + s["y"])


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum with the last digit counted once."""
    d = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        (2 * c.cast("int")) % 10 + (c.cast("int") >= 5).cast("int")))
    return F.aggregate(d, F.lit(0), lambda s, x: s + x)


def mod97(compact: Column) -> Column:
    """An account number modulo 97, its first four characters moved to the end and letters counted from ten."""
    moved = F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.substring(compact, 1, 4))
    values = F.transform(F.filter(F.split(moved, ""), lambda c: c != ""), lambda c: F.instr(F.lit(WORD.upper()), c) - 1)
    return F.aggregate(values, F.lit(0), lambda s, x: (s * F.when(x < 10, 10).otherwise(100) + x) % 97)


def only(value: Column, symbols: str) -> Column:
    """The characters of ``value`` that are in the class ``symbols``."""
    return F.regexp_replace(value, f"[^{symbols}]", "")


def refill(shape: Column, symbols: str, fresh: Column) -> Column:
    """``shape`` with its characters of the class ``symbols`` replaced, in order, by those of ``fresh``; capitals stay."""
    return let(fresh, lambda f: _refill(shape, symbols, f))


def _refill(shape: Column, symbols: str, fresh: Column) -> Column:
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def put(s: Column, run: Column) -> Column:
        take, new = run.rlike(f"^[{symbols}]"), F.substring(fresh, s["at"], F.length(run))
        written = F.array_join(F.zip_with(F.split(run, ""), F.split(new, ""), lambda c, n: F.when(c.rlike("^[A-Z]$"), F.upper(n)).otherwise(n)), "")
        return F.struct(
            F.concat(s["out"], F.when(take, written).otherwise(run)).alias("out"),
            (s["at"] + F.when(take, F.length(run)).otherwise(0)).alias("at"))

    return F.aggregate(F.regexp_extract_all(shape, F.lit(f"[{symbols}]+|[^{symbols}]+"), F.lit(0)), start, put, lambda s: s["out"])


def _ip(m: Column, key: str) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    number = F.aggregate(parts, F.lit(0).cast("bigint"), lambda s, x: s * 256 + x)
    return let(number_feistel(number, 65536, 65536, key, "ip"), lambda new: F.concat_ws(
        ".", *(F.shiftright(new, 8 * i).bitwiseAND(F.lit(255).cast("bigint")).cast("string") for i in (3, 2, 1, 0))))


def _date(m: Column, key: str, form: str) -> Column:
    first = F.lit(FIRST_DAY).cast("date")
    day = F.datediff(F.try_to_timestamp(m, F.lit(form)).cast("date"), first).cast("bigint")
    return let(day, lambda d: F.when(
        (d >= 0) & (d < DAY_A * DAY_B), F.date_format(F.date_add(first, number_feistel(d, DAY_A, DAY_B, key, "date").cast("int")), form)))


def _card(m: Column, key: str) -> Column:
    def fresh(digits: Column) -> Column:
        body = feistel(F.substring(digits, F.lit(1), F.length(digits) - 1), DIGITS, key, F.lit("card"))
        return let(body, lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))

    return let(only(m, "0-9"), lambda d: F.when(luhn_sum(d) % 10 == 0, refill(m, "0-9", fresh(d))))


def _iban(m: Column, key: str) -> Column:
    def letters(tail: Column) -> Column:
        return refill(tail, "A-Z", feistel(F.lower(only(tail, "A-Z")), LETTERS, key, F.concat(F.lit("iban"), only(tail, "0-9"))))

    def fresh(flat: Column) -> Column:
        tail, land = F.substring(flat, F.lit(5), F.length(flat)), F.substring(flat, 1, 2)
        numbers = refill(tail, "0-9", feistel(only(tail, "0-9"), DIGITS, key, F.lit("iban")))
        return let(let(numbers, letters), lambda t: F.concat(
            land, F.lpad((98 - mod97(F.concat(land, F.lit("00"), t))).cast("string"), 2, "0"), t))

    return let(F.replace(m, F.lit(" "), F.lit("")), lambda flat: F.when(
        F.length(flat).between(15, 34) & (mod97(flat) == 1), refill(m, "A-Z0-9", fresh(flat))))


def _parts(run: Column, group: str, most: int, rank: Callable[[Column], Column], fresh: Callable[[Column], Column]) -> Column:
    """``(text, n)``: a run of groups with its valid parts replaced, and their number.

    A part is one or more whole groups, at most ``most``. ``rank`` is null for a part that is not valid; of the valid parts
    that begin at a group the smallest rank counts, of rank 0 the shortest, of others the longest, and a part gives way to one of rank 0 inside it.
    """
    def spans(groups: Column) -> Column:
        return F.transform(groups, lambda g, i: F.array_min(F.filter(F.transform(
            F.sequence(F.lit(1), F.least(F.lit(most), F.size(groups) - i)),
            lambda w: let(rank(F.array_join(F.slice(groups, i + 1, w), "")), lambda r: F.struct(
                r.alias("rank"), F.when(r == 0, w).otherwise(-w).alias("order"), w.alias("w")))), lambda x: x["rank"].isNotNull())))

    def write(groups: Column, best: Column) -> Column:
        start = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("out"), F.lit(0).alias("n"))

        def step(s: Column, i: Column) -> Column:
            own = F.element_at(best, i)
            inside = F.exists(F.slice(best, i + 1, own["w"] - 1), lambda x: F.coalesce(x["rank"] == 0, F.lit(False)))
            take = own.isNotNull() & ((own["rank"] == 0) | ~F.coalesce(inside, F.lit(False)))
            return F.when(i < s["at"], s).when(take, F.struct(
                (i + own["w"]).alias("at"), F.array_append(s["out"], fresh(F.array_join(F.slice(groups, i, own["w"]), ""))).alias("out"),
                (s["n"] + 1).alias("n"))).otherwise(F.struct(
                    (i + 1).alias("at"), F.array_append(s["out"], F.element_at(groups, i)).alias("out"), s["n"].alias("n")))

        return F.aggregate(F.sequence(F.lit(1), F.size(groups)), start, step, lambda s: F.struct(F.array_join(s["out"], "").alias("text"), s["n"].alias("n")))

    return let(F.regexp_extract_all(run, F.lit(group), F.lit(0)), lambda groups: let(spans(groups), lambda best: write(groups, best)))


def _card_parts(run: Column, key: str) -> Column:
    def rank(part: Column) -> Column:
        return let(only(part, "0-9"), lambda d: F.when(
            F.length(d).between(13, 19), F.when(luhn_sum(d) % 10 == 0, F.when(part.rlike(CARD_FORM), 0).otherwise(1))))

    return _parts(run, CARD_GROUP, 19, rank, lambda part: _card(part, key))


def _iban_parts(run: Column, key: str) -> Column:
    def rank(part: Column) -> Column:
        return let(F.replace(part, F.lit(" "), F.lit("")), lambda flat: F.when(
            flat.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"), F.when(mod97(flat) == 1, 0)))

    return _parts(run, IBAN_GROUP, 9, rank, lambda part: F.concat(
        F.regexp_extract(part, "^ ?", 0), _iban(F.ltrim(part), key)))


def _mend(text: Column, run: str, long: str, parts: Callable[[Column], Column]) -> Column:
    """``(text, n)`` of a line whose replaced values stand between line feeds: parts of the runs elsewhere are replaced."""
    def segment(piece: Column) -> Column:
        return let(F.transform(F.regexp_extract_all(piece, F.lit(run), F.lit(0)), lambda m: F.when(m.rlike(long), parts(m)).otherwise(
            F.struct(m.alias("text"), F.lit(0).alias("n")))), lambda fresh: F.struct(
                F.array_join(F.zip_with(F.split(piece, run, -1), fresh, lambda t, m: F.concat(
                    t, F.coalesce(F.concat(F.lit("\n"), m["text"], F.lit("\n")), F.lit("")))), "").alias("text"),
                F.aggregate(fresh, F.lit(0), lambda n, x: n + x["n"]).alias("n")))

    pieces = F.transform(F.split(text, "\n", -1), lambda piece, i: F.when(i % 2 == 0, segment(piece)).otherwise(
        F.struct(F.concat(F.lit("\n"), piece, F.lit("\n")).alias("text"), F.lit(0).alias("n"))))
    return let(pieces, lambda p: F.struct(
        F.array_join(F.transform(p, lambda x: x["text"]), "").alias("text"), F.aggregate(p, F.lit(0), lambda n, x: n + x["n"]).alias("n")))


def _phone(m: Column, key: str) -> Column:
    """The country code of a number that begins with "+" stays."""
    def fresh(land: Column) -> Column:
        return let(F.substring(m, F.length(land) + 1, F.length(m)), lambda rest: F.concat(
            land, refill(rest, "0-9", feistel(only(rest, "0-9"), DIGITS, key, F.lit("phone")))))

    return F.when(F.length(only(m, "0-9")).between(7, 15), let(F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])", 0), fresh))


def _ssn(m: Column, key: str) -> Column:
    """Area, group and serial are numbers in their valid ranges; the 898 valid areas are counted from 0."""
    area, group, serial = (F.element_at(F.split(m, "-"), i).cast("int") for i in (1, 2, 3))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    number = ((area - 1 - (area > 666).cast("int")) * 99 + group - 1).cast("bigint") * 9999 + serial - 1

    def spell(new: Column) -> Column:
        place = (new / (99 * 9999)).cast("int")
        parts = (place + 1 + (place >= 665).cast("int"), (new / 9999).cast("int") % 99 + 1, (new % 9999).cast("int") + 1)
        return F.concat_ws("-", *(F.lpad(p.cast("string"), n, "0") for p, n in zip(parts, (3, 2, 4))))

    return F.when(valid, let(number_feistel(number, 898 * 99, 9999, key, "ssn"), spell))


def _secret(m: Column, key: str) -> Column:
    def fresh(value: Column) -> Column:
        return let(F.lower(only(value, "A-Za-z0-9")), lambda low: refill(value, "A-Za-z0-9", F.when(
            low.rlike("^[0-9a-f]+$"), feistel(low, HEX, key, F.lit("secret"))).otherwise(feistel(low, WORD, key, F.lit("secret")))))

    return let(F.regexp_extract(m, r"^[A-Za-z_-]+[\"']?\s*[=:]\s*[\"']?", 0), lambda head: F.concat(
        head, let(F.substring(m, F.length(head) + 1, F.length(m)), fresh)))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of a candidate, or null if its value is not valid."""
    is_kind = {k: m.rlike(f"^(?:{p})$") for k, p in PATTERNS.items()}
    octets = F.forall(F.split(m, r"\."), lambda x: x.cast("int") < 256)
    out = F.when(is_kind["secret"], _secret(m, key))
    out = out.when(is_kind["key"], F.concat(F.substring(m, 1, 4), F.upper(feistel(F.lower(F.substring(m, 5, 16)), WORD, key, F.lit("key")))))
    out = out.when(is_kind["email"], refill(m, "A-Za-z0-9", feistel(F.lower(only(m, "A-Za-z0-9")), WORD, key, F.lit("email"))))
    out = out.when(is_kind["ip"], F.when(octets, _ip(m, key)))
    out = out.when(is_kind["date"], F.when(m.contains("-"), _date(m, key, "yyyy-MM-dd")).when(m.contains("."), _date(m, key, "dd.MM.yyyy"))
                   .otherwise(F.coalesce(_date(m, key, "dd/MM/yyyy"), _date(m, key, "MM/dd/yyyy"))))
    out = out.when(is_kind["ssn"], _ssn(m, key))
    return out.otherwise(F.coalesce(
        F.when(is_kind["iban"], _iban(m, key)), F.when(is_kind["card"] & m.rlike(CARD_FORM), _card(m, key)), F.when(is_kind["phone"], _phone(m, key))))


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text with pseudonyms, n_found (candidates), n_replaced (valid ones).

    A null text is an empty one; texts of any length are searched whole; repeated rows give repeated rows. Candidates
    that fail their check, such as a number of a card's length without its check digit, stay as they are, but for the valid
    card and account numbers made of some of their groups. Every text is
    split and joined in place: there is no shuffle, so frequent values and hot sources make no difference.
    """

    def line(text: Column) -> Column:
        """Valid candidates replaced, each between line feeds, which no line has of its own."""
        def join(found: Column) -> Column:
            return let(F.transform(found, lambda m: pseudonym(m, key)), lambda fresh: F.struct(
                F.array_join(F.zip_with(
                    F.split(text, ANY, -1), F.zip_with(found, fresh, lambda m, f: F.coalesce(F.concat(F.lit("\n"), f, F.lit("\n")), m)),
                    lambda t, m: F.concat(t, F.coalesce(m, F.lit("")))), "").alias("text"),
                F.size(found).alias("found"), F.size(F.filter(fresh, lambda x: x.isNotNull())).alias("replaced"),
                F.exists(F.zip_with(found, fresh, lambda m, f: f.isNull() & m.rlike(NUMBERS)), lambda x: x).alias("failed")))

        return F.when(text.rlike(HINT), let(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), join)).otherwise(
            F.struct(text.alias("text"), F.lit(0).alias("found"), F.lit(0).alias("replaced"), F.lit(False).alias("failed")))

    def mended(run: str, long: str, parts: Callable[[Column, str], Column]) -> Column:
        def one(x: Column) -> Column:
            return F.when(~x["failed"], x).otherwise(let(_mend(x["text"], run, long, lambda m: parts(m, key)), lambda p: F.struct(
                p["text"].alias("text"), F.greatest(x["found"], x["replaced"] + p["n"]).alias("found"),
                (x["replaced"] + p["n"]).alias("replaced"), x["failed"].alias("failed"))))

        return F.transform("lines", one).alias("lines")

    lines = texts(docs, id_col, text_col).select("doc_id", F.transform(F.split("text", "\n", -1), line).alias("lines"))
    # accounts first; what is in a run of groups that begins like an account is no card
    for step in ((IBAN_RUN, ".{15}", _iban_parts), (CARD_RUN, ".{13}", _card_parts)):
        lines = lines.select("doc_id", mended(*step))
    count = lambda name: F.aggregate(F.col(f"lines.{name}"), F.lit(0).cast("bigint"), lambda s, x: s + x).alias(f"n_{name}")
    return lines.select("doc_id", F.array_join(F.transform("lines.text", lambda t: F.replace(t, F.lit("\n"), F.lit(""))), "\n").alias("text"), count("found"), count("replaced"))
