"""The JSON rules against a brute-force rewrite of random documents."""

import json
from decimal import Decimal
from random import Random, SystemRandom

from pyspark.sql import functions as F

from rillet.functions.jsons import canonical_json, drop_null_members, is_json_object, plain_numbers, with_member

ALPHABET = 'ab"\\{}[]:, null1e3\t\né '
NUMBERS = [
    "0", "-0", "7", "-12", "1.0", "1.50", "-0.00", "1e3", "1E+2", "-2.5e-3", "120e-1", "0.0e5", "12e-30", "1.5e20",
     "12345678901234567890123456789012345678901", "0.1000000000000000055511151231257827", "1e99999999",
     "1e+99999", "1e0000003", "1e99999999999999999999", "0e99999999999", "1e37", "1e38", "9.5e-37", "9.5e-38", "10000e-41", "1.00e-38",
]


class Number(str):
    """A number as it is written."""


def write(value, space):
    if isinstance(value, Number):
        return str(value)
    if isinstance(value, dict):
        return "{" + space + (space + "," + space).join(f"{json.dumps(k)}{space}:{space}{write(v, space)}" for k, v in value.items()) + space + "}"
    if isinstance(value, list):
        return "[" + space + ("," + space).join(write(v, space) for v in value) + space + "]"
    return json.dumps(value, ensure_ascii=False)


def without_nulls(value):
    if isinstance(value, dict):
        return {k: without_nulls(v) for k, v in value.items() if v is not None}
    if isinstance(value, list):
        return [without_nulls(v) for v in value]
    return value


def plain(number):
    if not any(c in number for c in ".eE"):
        return number
    mantissa, _, exponent = number.lstrip("-").lower().partition("e")
    whole, _, fraction = mantissa.partition(".")
    digits = (whole + fraction).lstrip("0")
    if not digits:
        return "0"
    point = len(digits) - len(fraction) + int(exponent or 0)
    digits = digits.rstrip("0")
    if max(point, 0) + max(len(digits) - point, 0) > 38:
        return number
    text = format(Decimal(number), "f")
    text = text.rstrip("0").rstrip(".") if "." in text else text
    return "0" if text == "-0" else text


def plain_document(value):
    if isinstance(value, Number):
        return Number(plain(value))
    if isinstance(value, dict):
        return {k: plain_document(v) for k, v in value.items()}
    if isinstance(value, list):
        return [plain_document(v) for v in value]
    return value


def random_value(random, depth):
    """A JSON value; with depth 0 neither an array nor an object."""
    kind = random.randrange(7 if depth else 5)
    if kind == 5:
        return [random_value(random, depth - 1) for _ in range(random.randrange(4))]
    if kind == 6:
        return {random_text(random): random_value(random, depth - 1) for _ in range(random.randrange(5))}
    return [None, random.random() < 0.5, Number(random.choice(NUMBERS)), Number(random.choice(NUMBERS)), random_text(random)][kind]


def random_text(random):
    return "".join(random.choice(ALPHABET) for _ in range(random.randrange(13)))


def test_random_documents(spark):
    seed = SystemRandom().randrange(2**32)
    print(f"seed {seed}")
    random = Random(seed)
    documents = [
        {random_text(random): random_value(random, 3) for _ in range(random.randrange(6))} for _ in range(400)
    ]
    cases = []
    for document in documents:
        for space in ("", " \n"):
            cases.append((
                write(document, space), write(without_nulls(document), ""), write(plain_document(document), space),
                write(plain_document(without_nulls(document)), ""),
            ))
    docs = spark.createDataFrame(cases, "doc string, no_nulls string, plain string, canonical string")
    result = docs.selectExpr(
        f"{drop_null_members('doc')} AS d", "no_nulls", f"{plain_numbers('doc')} AS p", "plain", f"{canonical_json('doc')} AS c", "canonical"
    ).collect()
    # Members can be dropped without touching anything else, so only blanks may differ.
    read = lambda text: json.loads(text, parse_float=Number, parse_int=Number)
    for row in result:
        assert read(row["d"]) == read(row["no_nulls"])
        assert row["p"] == row["plain"]
        assert read(row["c"]) == read(row["canonical"])


def test_compact_documents_stay_compact(spark):
    docs = ['{"a":null}', '{"a":null,"b":null}', '{"a":1,"b":null,"c":[null,{"d":null}]}', '{"b":"\\"a\\":null,"}', "[]", "null"]
    frame = spark.createDataFrame([(d,) for d in docs], "doc string")
    assert [r[0] for r in frame.selectExpr(drop_null_members("doc")).collect()] == [
        "{}", "{}", '{"a":1,"c":[null,{}]}', '{"b":"\\"a\\":null,"}', "[]", "null",
    ]


def test_long_strings(spark):
    text = 'x\\"' * 200_000
    doc = f'{{"a":"{text}","b":null,"c":1.0}}'
    frame = spark.createDataFrame([(doc,)], "doc string")
    assert frame.selectExpr(canonical_json("doc")).first()[0] == f'{{"a":"{text}","c":1}}'


def test_with_member(spark):
    frame = spark.createDataFrame([(' { "a":1}',), ("{ }",), ("{}",)], "doc string")
    added = frame.selectExpr(with_member("doc", "v", "'1-0-0'")).collect()
    assert [r[0] for r in added] == ['{"v":"1-0-0","a":1}', '{"v":"1-0-0"}', '{"v":"1-0-0"}']
    assert all(r[0] for r in frame.selectExpr(is_json_object("doc")).collect())


def test_large_numbers_survive_in_the_text(spark):
    number = "9" * 41
    frame = spark.createDataFrame([(f'{{"n":{number}}}',)], "doc string")
    assert frame.selectExpr(canonical_json("doc")).first()[0] == f'{{"n":{number}}}'
    small = spark.createDataFrame([('{"n":' + "9" * 38 + "}",)], "doc string")
    assert small.select(F.to_json(F.parse_json("doc"))).first()[0] == '{"n":' + "9" * 38 + "}"
