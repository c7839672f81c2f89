"""Values of any Spark type to a column's type, as SQL expressions made from the two types."""

from pyspark.sql import types as T

from rillet.functions.casts import typed_value

_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def is_number(data_type: T.DataType) -> bool:
    return isinstance(data_type, _NUMBERS)


def converted(value: str, source: T.DataType, target: T.DataType, depth: int = 0) -> str | None:
    """SQL for ``value`` of type ``source`` as ``target``; None if no value of the one is a value of the other.

    A value of the right kind that does not fit gives null, as null does.  Texts are read strictly: numbers, times and
    booleans in the forms of `rillet.functions.casts`, arrays, structs, maps and variants as JSON, where of a
    repeated key the last value counts.  Elements, keys and fields are converted by the same rules; one
    that does not fit is null in its place.  A field that the source lacks is null, one that
    the target lacks is left out.
    """
    if source == target:
        return value
    if isinstance(target, T.VariantType):
        if isinstance(source, T.StringType):
            return f"try_parse_json({value})"
        if isinstance(source, _NESTED):
            keys_are_text = not isinstance(source, T.MapType) or isinstance(source.keyType, T.StringType)
            return f"to_variant_object({value})" if keys_are_text else None
        return f"CAST({value} AS VARIANT)"
    if isinstance(source, T.VariantType):
        return f"try_variant_get({value}, '$', '{target.simpleString()}')"
    if isinstance(target, T.StringType):
        return f"to_json({value})" if isinstance(source, _NESTED) else f"CAST({value} AS STRING)"
    if isinstance(source, T.StringType):
        if isinstance(target, _NESTED):
            return f"try_variant_get(try_parse_json({value}), '$', '{target.simpleString()}')"
        return typed_value(value, target.simpleString())
    if isinstance(target, _NESTED):
        return _nested(value, source, target, depth)
    same_kind = any(isinstance(source, kind) and isinstance(target, kind) for kind in (_NUMBERS, _TIMES))
    return f"try_cast({value} AS {target.simpleString()})" if same_kind else None


def _nested(value: str, source: T.DataType, target: T.DataType, depth: int) -> str | None:
    x, y = f"x{depth}", f"y{depth}"
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        element = converted(x, source.elementType, target.elementType, depth + 1)
        return element and f"transform({value}, {x} -> {element})"
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        key = converted(x, source.keyType, target.keyType, depth + 1)
        element = converted(y, source.valueType, target.valueType, depth + 1)
        return key and element and f"transform_values(transform_keys({value}, ({x}, {y}) -> {key}), ({x}, {y}) -> {element})"
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        held = {field.name: field for field in source}
        members = []
        for field in target:
            if field.name in held:
                member = converted(f"{value}.`{field.name}`", held[field.name].dataType, field.dataType, depth)
                if member is None:
                    return None
            else:
                member = f"CAST(NULL AS {field.dataType.simpleString()})"
            members.append(f"'{field.name}', {member}")
        return f"CASE WHEN {value} IS NOT NULL THEN named_struct({', '.join(members)}) END"
    return None
