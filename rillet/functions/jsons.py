"""JSON texts in the form in which they are stored: no null members, plain numbers.

The functions take and return SQL expressions.

The rules:

* a member whose value is null is removed, at every depth; null elements of arrays stay;
* a number is written without an exponent and without trailing fraction zeros, digit by digit
  exact (``1e3`` and ``1000.0`` become ``1000``), so that no digit is lost to a double.  A number
  whose plain form has more digits than a VARIANT holds exactly is left as it is written;
* everything else is left as it is.

Each rule is one pass of regular expressions that step over whole JSON strings, so text inside
strings is never touched.  The rules see the text as it stands: of a key that an object repeats,
each mention counts, so repeated keys are resolved before (`rillet.operators.parse`).  Both passes are skipped for texts that cannot need them.
"""
# A JSON string. Possessive, so long strings need no backtracking and no stack.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_NULL_MEMBER = rf"\s*+{_STRING}\s*+:\s*+null\s*+"
# Null members at the start of an object, null members after a comma, or a string to step over.
_NULL_MEMBERS = (
    rf"(?s)(?<=\{{)(?:{_NULL_MEMBER}(?:,|(?=\}})))++"
    rf"|,{_NULL_MEMBER}(?=[,}}])"
    rf"|({_STRING})"
)

_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?"
_TOKENS = rf'(?s){_STRING}|{_NUMBER}|[^"0-9-]++|.'
# A number with a fraction or an exponent, where a JSON value may stand.
_NOT_PLAIN = r"(?:\A|[\[:,\s])-?[0-9]++(?:\.|[eE])"
_NOT_PLAIN_NUMBER = r"\A-?[0-9]+[.eE]"
_NUMBER_PARTS = r"\A(-?)([0-9]+)(?:\.([0-9]+))?(?:[eE]([+-]?[0-9]+))?\z"
_BLANKS = r"' \t\r\n'"
# What a number must contain that Spark would read as a double although a plain form is exact.
_MAYBE_INEXACT = r"[0-9][eE]|[0-9.]{39}"
# Digits that a VARIANT holds exactly.
_EXACT_DIGITS = 38
# What a number beyond the range of a double must contain: a large exponent or very many digits.
_MAYBE_INFINITE = r"[eE]\+?0*[1-9][0-9]{2}|[0-9]{200}"


def bind(value: str, name: str, use: str) -> str:
    """``use``, in which ``name`` stands for ``value``, which is computed once.

    Keeps nested rewrites linear in size: Spark would copy the expression to each mention.
    """
    return f"get(transform(array({value}), {name} -> {use}), 0)"


def drop_null_members(json: str) -> str:
    """Remove null-valued object members at every depth."""
    return f"CASE WHEN contains({json}, 'null') THEN regexp_replace({json}, r'{_NULL_MEMBERS}', '$1') ELSE {json} END"


def plain_number(token: str) -> str:
    """A JSON number without exponent and without trailing fraction zeros, exact to the digit.

    Left as written if that takes more than the 38 digits that a VARIANT holds exactly.
    """

    def part(group: int) -> str:
        return f"regexp_extract({token}, r'{_NUMBER_PARTS}', {group})"

    parts = f"struct({part(1)} AS sign, {part(2)} AS whole, {part(3)} AS fraction, {part(4)} AS exponent)"
    # The digits, and where the decimal point goes, counted from their left end; null for an exponent beyond INT.
    placed = """struct(p.sign AS sign, concat(p.whole, p.fraction) AS digits, length(p.whole)
        + CAST(CASE WHEN p.exponent = '' THEN 0 ELSE try_cast(p.exponent AS INT) END AS BIGINT) AS point)"""
    stripped = """struct(d.sign AS sign, trim('0', d.digits) AS digits,
        d.point - length(d.digits) + length(ltrim('0', d.digits)) AS point)"""
    written = f"""CASE WHEN n.digits = '' THEN '0'
        WHEN n.point IS NULL OR greatest(n.point, 0) + greatest(length(n.digits) - n.point, 0) > {_EXACT_DIGITS} THEN {token}
        WHEN n.point <= 0 THEN concat(n.sign, '0.', repeat('0', CAST(-n.point AS INT)), n.digits)
        WHEN n.point >= length(n.digits) THEN concat(n.sign, rpad(n.digits, CAST(n.point AS INT), '0'))
        ELSE concat(n.sign, substring(n.digits, 1, CAST(n.point AS INT)), '.', substring(n.digits, CAST(n.point AS INT) + 1)) END"""
    return bind(parts, "p", bind(bind(placed, "d", stripped), "n", written))


def plain_numbers(json: str) -> str:
    """Write every number of a JSON text in plain form."""
    token = f"CASE WHEN t RLIKE r'{_NOT_PLAIN_NUMBER}' THEN {plain_number('t')} ELSE t END"
    rewritten = f"array_join(transform(regexp_extract_all({json}, r'{_TOKENS}', 0), t -> {token}), '')"
    return f"CASE WHEN {json} RLIKE r'{_NOT_PLAIN}' THEN {rewritten} ELSE {json} END"


def exact_numbers(json: str) -> str:
    """Write those numbers in plain form that Spark would otherwise read as doubles."""
    return f"CASE WHEN {json} RLIKE r'{_MAYBE_INEXACT}' THEN {plain_numbers(json)} ELSE {json} END"


def mark_infinite(json: str, marker: str) -> str:
    """Put the string ``marker`` in place of each number beyond the range of a double.

    Spark would read such a number as the text "Infinity", which a string may hold as well.
    """
    infinite = f"t RLIKE r'\\A-?[0-9]' AND abs(try_cast(t AS DOUBLE)) = double('Infinity')"
    marked = f"""array_join(transform(regexp_extract_all({json}, r'{_TOKENS}', 0),
        t -> CASE WHEN {infinite} THEN concat('"', {marker}, '"') ELSE t END), '')"""
    return f"CASE WHEN {json} RLIKE r'{_MAYBE_INFINITE}' THEN {marked} ELSE {json} END"


def canonical_json(json: str) -> str:
    """Both rules together."""
    return bind(drop_null_members(json), "j", plain_numbers("j"))


def is_json_object(json: str) -> str:
    """For a text that is known to be JSON."""
    return f"coalesce(startswith(ltrim({_BLANKS}, {json}), '{{'), false)"


def with_member(json_object: str, key: str, value: str) -> str:
    """Put a string member at the front of a JSON object text."""
    inner = f"ltrim({_BLANKS}, substring(ltrim({_BLANKS}, {json_object}), 2))"
    joined = f"""concat('{{"{key}":"', {value}, CASE WHEN startswith(inner, '}}') THEN '"' ELSE '",' END, inner)"""
    return bind(inner, "inner", joined)
