"""Personal data: format-preserving Feistel pseudonyms, in SQL expressions only.

A value is found by its form, validated (check digits, ranges, calendar) and replaced by another one of the same form: a keyed permutation
of all values of that form, so equal values get equal pseudonyms in all documents and different values different ones. Who has
the key can undo it. Where a form has fewer valid values than its digits allow, the permutation is walked on until it is valid again, so
pseudonyms are valid values too and the set of valid values is permuted within itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Steps of a walk; of dates and numbers a step misses with less than one half, so a walk of this length misses with less than 2 ** -64.
WALK = 64

# The forms that are looked for, in order of precedence where two begin at one place.
FORMS = {
    "mail": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "secret": r"(?<![\p{L}\p{N}])(?:AKIA[0-9A-Z]{16}(?![\p{L}\p{N}])|(?i:token|password|passwd|secret|api_?key)[^\p{L}\p{N}\n]{0,3}[=:][^\p{L}\p{N}\n]{0,3}[A-Za-z0-9+/_-]{12,128})",
    "phone": r"(?<![\p{L}\p{N}])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|(?<=[0-9][ .-]?)[0-9]{2,4}[ .-][0-9]{3,4}[ .-][0-9]{3,4}|[0-9]{3}-[0-9]{3}-[0-9]{4})(?![\p{L}\p{N}])",
    "date": r"(?<![\p{L}\p{N}/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![\p{N}/-]|\.[0-9])",
    "ssn": r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])",
    "ip": r"(?<![\p{N}.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\p{N}]|\.[0-9])",
    "card": r"(?<![\p{L}\p{N}])[0-9](?:[ -]?[0-9]){12,18}(?![\p{L}\p{N}])",
}
#: First day of the dates, and the two factors their number is split into.
DAYS_FROM, DAYS = "1800-01-01", (189, 773)  # 400 years of the calendar are 189 * 773 days


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def noise(key: str, kind: str, turn: str, half: str) -> str:
    """60 keyed bits of one half in one round."""
    return f"cast(conv(substr(sha2(concat_ws('|', {sql_text(key)}, '{kind}', {turn}, {half}), 256), 1, 15), 16, 10) as bigint)"


def permuted(key: str, kind: str, left: str, right: str, left_size: str, right_size: str) -> str:
    """Feistel rounds on a pair of numbers below two sizes: a struct of both."""
    step = (f"named_struct('l', if(i % 2 = 0, pmod(s.l + {noise(key, kind, 'i', 's.r')}, {left_size}), s.l), "
            f"'r', if(i % 2 = 1, pmod(s.r + {noise(key, kind, 'i', 's.l')}, {right_size}), s.r))")
    return f"aggregate(sequence(1, {ROUNDS}), named_struct('l', {left}, 'r', {right}), (s, i) -> {step})"


def permuted_digits(key: str, kind: str, digits: str) -> str:
    """A string of up to 36 digits, permuted among those of its length."""
    n = f"length({digits})"
    left = f"cast(substr({digits}, 1, {n} div 2) as bigint)"
    right = f"cast(substr({digits}, {n} div 2 + 1) as bigint)"
    sizes = [f"cast(pow(10, {n} div 2) as bigint)", f"cast(pow(10, {n} - {n} div 2) as bigint)"]
    pair = permuted(key, f"{kind}", left, right, *sizes)
    return f"transform(array({pair}), p -> concat(lpad(cast(p.l as string), cast({n} div 2 as int), '0'), lpad(cast(p.r as string), cast({n} - {n} div 2 as int), '0')))[0]"


def walked(first: str, step: str, valid: str) -> str:
    """``first``, replaced by ``step`` of itself (as ``at``) until ``valid`` (of ``at``) holds."""
    return f"aggregate(sequence(1, {WALK}), {first}, (at, walk) -> if({valid}, at, {step}))"


def refilled(form: str, digits: str) -> str:
    """``form`` with its digits replaced by ``digits``, one after the other."""
    return (f"aggregate(split({form}, ''), named_struct('o', '', 'k', 1), (s, c) -> if(c rlike '[0-9]', "
            f"named_struct('o', concat(s.o, substr({digits}, s.k, 1)), 'k', s.k + 1), named_struct('o', concat(s.o, c), 'k', s.k)), s -> s.o)")


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def digit_sum(digits: str) -> str:
    """Luhn sum of digits whose check digit is still to come."""
    return (f"aggregate(sequence(1, length({digits})), 0, (t, i) -> t + transform(array(cast(substr({digits}, length({digits}) + 1 - i, 1) as int)), "
            f"d -> if(i % 2 = 1, if(d > 4, 2 * d - 9, 2 * d), d))[0])")


def shifted(text: str, other: str, key: str, turn: str) -> str:
    """Each letter and digit of ``text`` moved within its kind by keyed bytes of ``other``."""
    pad = f"concat_ws('|', {sql_text(key)}, 'text', {turn}, length({text}), {other})"
    byte = "cast(conv(substr(h[j div 32], 2 * (j % 32) + 1, 2), 16, 10) as int)"
    stream = f"transform(sequence(0, length({text}) div 32), b -> sha2(concat_ws('|', {pad}, b), 256))"
    # Other letters move within their row of 32 code points, which keeps the alphabet.
    point = f"ascii(c) - ascii(c) % 32 + (ascii(c) % 32 + {byte}) % 32"
    other_letter = f"decode(unhex(lpad(hex({point}), 8, '0')), 'UTF-32')"
    moved = (f"case when c between '0' and '9' then char(48 + (ascii(c) - 48 + {byte}) % 10) "
             f"when ascii(c) between 97 and 102 then char(97 + (ascii(c) - 97 + {byte}) % 6) when ascii(c) between 103 and 122 then char(103 + (ascii(c) - 103 + {byte}) % 20) "
             f"when ascii(c) between 65 and 70 then char(65 + (ascii(c) - 65 + {byte}) % 6) when ascii(c) between 71 and 90 then char(71 + (ascii(c) - 71 + {byte}) % 20) "
             f"when ascii(c) > 127 then {other_letter} else c end")
    return f"if({text} = '', '', {let(stream, 'h', f'''array_join(transform(split({text}, ''), (c, j) -> {moved}), '')''')})"


def permuted_text(key: str, text: str) -> str:
    """Feistel rounds on the halves of a string; letters of hexadecimal digits stay such."""
    step = (f"named_struct('l', if(i % 2 = 0, {shifted('s.l', 's.r', key, 'i')}, s.l), 'r', if(i % 2 = 1, {shifted('s.r', 's.l', key, 'i')}, s.r))")
    start = f"named_struct('l', substr({text}, 1, length({text}) div 2), 'r', substr({text}, length({text}) div 2 + 1))"
    return f"aggregate(sequence(1, {ROUNDS}), {start}, (s, i) -> {step}, s -> concat(s.l, s.r))"


def pseudonym(key: str) -> str:
    """SQL of the pseudonym of the value ``v``; a value that fails validation stays."""
    digits = "regexp_replace(v, '[^0-9]', '')"
    card = let(digits, "d", f"if(length(d) between 13 and 19 and ({digit_sum('substr(d, 1, length(d) - 1)')} + cast(right(d, 1) as int)) % 10 = 0 and d rlike '[1-9]', " + let(
        permuted_digits(key, "card", "substr(d, 1, length(d) - 1)"), "e", let(f"concat(e, cast((10 - {digit_sum('e')} % 10) % 10 as string))", "f", refilled("v", "f"))) + ", v)")
    country = "regexp_extract(v, '^[+][0-9]{1,3}(?=[^0-9])', 0)"
    phone = let(country, "c", let("regexp_replace(substr(v, length(c) + 1), '[^0-9]', '')", "d", f"if(length(d) between 7 and 14, concat(c, {let('substr(v, length(c) + 1)', 'w', let(permuted_digits(key, 'phone', 'd'), 'e', refilled('w', 'e')))}), v)"))
    right_ssn = "rlike '^(?!000|666|9)[0-9]{3}(?!00)[0-9]{2}(?!0000)[0-9]{4}$'"
    ssn = let(digits, "d", f"if(d {right_ssn}, {let(walked(permuted_digits(key, 'ssn', 'd'), permuted_digits(key, 'ssn', 'at'), 'at ' + right_ssn), 'e', refilled('v', 'e'))}, v)")
    octets = "transform(split(v, '[.]'), x -> cast(x as bigint))"
    four = permuted(key, "ip", "o[0] * 256 + o[1]", "o[2] * 256 + o[3]", "65536", "65536")
    ip = let(octets, "o", "if(forall(o, x -> x <= 255), " + let(four, "p", "concat_ws('.', p.l div 256, p.l % 256, p.r div 256, p.r % 256)") + ", v)")
    order = "case when substr(v, 5, 1) rlike '[-/]' then 'y' when substr(v, 3, 1) = '.' then 'd' when try_cast(concat(right(v, 4), '-', substr(v, 1, 2), '-', substr(v, 4, 2)) as date) is null then 'd' else 'm' end"
    iso = "case o when 'y' then replace(v, '/', '-') when 'd' then concat(right(v, 4), '-', substr(v, 4, 2), '-', left(v, 2)) else concat(right(v, 4), '-', left(v, 2), '-', substr(v, 4, 2)) end"
    # A date with a slash is month first if that makes a date, else day first. So that each reading stays with its own values, a date that
    # can only be day first becomes another day beyond the twelfth, and all others are permuted among all dates.
    day = lambda n: f"date_add(date'{DAYS_FROM}', cast({n} as int))"
    turn = lambda n: let(permuted(key, "date", f"{n} div {DAYS[1]}", f"{n} % {DAYS[1]}", str(DAYS[0]), str(DAYS[1])), "p", f"p.l * {DAYS[1]} + p.r")
    late = f"o <> 'd' or substr(v, 3, 1) = '.' or day({day('at')}) > 12"
    number = let(f"cast(datediff(try_cast({iso} as date), date'{DAYS_FROM}') as bigint)", "n", "if(n is null or n < 0 or n >= 146097, v, " + let(
        walked(turn("n"), turn("at"), late), "m", let(day("m"), "t",
            "case o when 'y' then date_format(t, concat('yyyy', substr(v, 5, 1), 'MM', substr(v, 5, 1), 'dd')) when 'd' then date_format(t, concat('dd', substr(v, 3, 1), 'MM', substr(v, 3, 1), 'yyyy')) else date_format(t, 'MM/dd/yyyy') end")) + ")")
    date = let(order, "o", number)
    bare = "replace(v, ' ', '')"
    rest = ("aggregate(split({x}, ''), cast(0 as bigint), (t, c) -> if(c rlike '[0-9]', (t * 10 + cast(c as bigint)) % 97, (t * 100 + ascii(c) - 55) % 97))")
    iban = let(bare, "b", f"if(length(b) between 15 and 34 and {rest.format(x='concat(substr(b, 5), left(b, 4))')} = 1, " + let(
        permuted_text(key, "substr(b, 5)"), "e", let(f"concat(left(b, 2), lpad(cast(98 - {rest.format(x='''concat(e, left(b, 2), '00')''')} as string), 2, '0'), e)", "f",
            "aggregate(split(v, ''), named_struct('o', '', 'k', 1), (s, c) -> if(c = ' ', named_struct('o', concat(s.o, c), 'k', s.k), named_struct('o', concat(s.o, substr(f, s.k, 1)), 'k', s.k + 1)), s -> s.o)")) + ", v)")
    mail = f"concat({let('''substring_index(v, '@', 1)''', 'u', permuted_text(key, 'u'))}, '@', substring_index(v, '@', -1))"
    named = "regexp_extract(v, '^(AKIA|[^=:]*[=:][^A-Za-z0-9+/_-]*)', 0)"
    secret = let(named, "u", f"concat(u, {let('substr(v, length(u) + 1)', 'w', permuted_text(key, 'w'))})")
    whole = lambda name: sql_text("^" + loose(FORMS[name]) + "$")
    kinds = {"mail": mail, "iban": iban, "secret": secret, "date": date, "ssn": ssn, "ip": ip, "phone": phone, "card": card}
    return "case " + " ".join(f"when v rlike {whole(name)} then {expression}" for name, expression in kinds.items()) + " else v end"


def loose(form: str) -> str:
    """A form without what it asks of its surroundings, for a value that was cut out."""
    if form.startswith("(?<!"):
        form = form[form.index(")") + 1:]
    return "(?:" + form + ")"


def pseudonymise(documents: DataFrame, key: str, column: str = "text") -> DataFrame:
    """``documents`` with personal data in ``column`` replaced; ``n_pii`` counts the values that were changed. ``key`` is the secret of the permutations.

    Mail addresses (the part before @), IBANs (check digits made anew), card numbers (13 to 19 digits with a right Luhn digit, made anew), phone
    numbers (all but the country code), social security numbers, IPv4 addresses, dates of the years 1800 to 2199, and the secret part of
    keys and passwords. Numbers that fail validation stay as they are. Each form is permuted on its own: spaces and separators
    stay, letters stay letters of their alphabet, digits digits.

    A null text stays null, an empty one empty; texts of any length are scanned once, with bounded look-around. Rows are
    independent, so repeated rows, ties and an empty table need no rule; other columns are kept whatever their names (``n_pii`` is replaced).
    """
    if not key:
        raise ValueError("a key is needed")
    found = sql_text("|".join(FORMS.values()))
    text = f"`{column}`"
    values = f"transform(regexp_extract_all({text}, {found}, 0), v -> named_struct('v', v, 'p', {pseudonym(key)}))"
    # A text without digit, @ sign or assignment holds none of the forms.
    likely = f"{text} rlike '[0-9@=:]'"
    own = "_pii"
    while own in documents.columns:
        own += "_"
    held = documents.withColumn(own, F.expr(f"if({likely}, {values}, null)"))
    joined = f"concat_ws('', transform(arrays_zip(split({text}, {found}, -1), {own}), z -> concat(z['0'], coalesce(z['{own}'].p, ''))))"
    return (held.withColumn("n_pii", F.expr(f"coalesce(size(filter({own}, x -> x.p <> x.v)), 0)").cast("long"))
            .withColumn(column, F.expr(f"if(size({own}) > 0, {joined}, {text})")).drop(own))
