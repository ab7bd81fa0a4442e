"""Read the final assistant response out of a chat column.

A response column is a string, or an array of messages. A message is a struct or a
string map with ``role`` and ``content``. Which of these it is gets decided once, from
the column's data type, when the plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.functions.binding import let


def message_field(message: Column, message_type: T.DataType, key: str) -> Column:
    """Field ``key`` of a message; null where the message or the field is missing."""
    if isinstance(message_type, T.StructType):
        return message.getField(key) if key in message_type.names else F.lit(None).cast("string")
    if isinstance(message_type, T.MapType):
        return message.getItem(key)
    raise TypeError(f"a message must be a struct or a map, not {message_type.simpleString()}")


def _field_type(message_type: T.DataType, key: str) -> T.DataType:
    if isinstance(message_type, T.MapType):
        return message_type.valueType
    return message_type[key].dataType if key in message_type.names else T.StringType()


def _usable_text(value: Column, value_type: T.DataType) -> Column:
    """The value as text, null where it is empty, zero or false."""
    if isinstance(value_type, T.BooleanType):
        return F.when(value, F.lit("True"))
    if isinstance(value_type, T.NumericType):
        return F.when(value != F.lit(0), value.cast("string"))
    if isinstance(value_type, (T.ArrayType, T.MapType)):
        return F.when(F.size(value) > 0, value.cast("string"))
    return F.nullif(value.cast("string"), F.lit(""))


def _check(response_type: T.DataType) -> None:
    if not isinstance(response_type, (T.StringType, T.ArrayType)):
        raise TypeError(
            f"a response must be a string or an array, not {response_type.simpleString()}"
        )


def final_response(response: Column, response_type: T.DataType) -> Column:
    """Text of the last assistant message with content, else the last message's content.

    A string is the response itself, also when it is empty. Null means there is none.
    """
    _check(response_type)
    if isinstance(response_type, T.StringType):
        return response
    message_type = response_type.elementType

    def content(message: Column) -> Column:
        return _usable_text(
            message_field(message, message_type, "content"),
            _field_type(message_type, "content"),
        )

    def pick(messages: Column) -> Column:
        answers = F.filter(
            messages,
            lambda m: (message_field(m, message_type, "role") == "assistant")
            & content(m).isNotNull(),
        )
        return F.coalesce(
            content(F.get(answers, F.size(answers) - 1)),
            content(F.get(messages, F.size(messages) - 1)),
        )

    return let(response, pick)


def response_problem(response: Column, response_type: T.DataType) -> Column:
    """``empty`` for null or ``[]``, ``no_content`` for unusable messages, else null."""
    _check(response_type)
    if isinstance(response_type, T.StringType):
        return F.when(response.isNull(), F.lit("empty"))
    return F.when(response.isNull() | (F.size(response) == 0), F.lit("empty")).when(
        final_response(response, response_type).isNull(), F.lit("no_content")
    )
