from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from prefspark.operators.preferences import first_rows, invalid_preferences, preference_examples
from prefspark.functions.messages import final_response, response_problem

STRUCTS = "array<struct<role:string,content:string>>"
MAPS = "array<map<string,string>>"


def respond(spark, value, ddl):
    frame = spark.createDataFrame([(value,)], f"r {ddl}")
    kind = frame.schema["r"].dataType
    return tuple(
        frame.select(final_response(F.col("r"), kind), response_problem(F.col("r"), kind)).first()
    )


@pytest.mark.parametrize(
    "messages, expected",
    [
        ([("user", "Question"), ("assistant", "Preferred answer")], ("Preferred answer", None)),
        ([("assistant", "first"), ("user", "more"), ("assistant", "last")], ("last", None)),
        ([("assistant", "kept"), ("assistant", "")], ("kept", None)),
        ([("assistant", "kept"), ("assistant", None)], ("kept", None)),
        ([("system", "s"), ("user", "only this")], ("only this", None)),
        ([("assistant", "kept"), ("user", "")], ("kept", None)),
        ([("user", "x"), ("user", "")], (None, "no_content")),
        ([("user", ""), ("assistant", "")], (None, "no_content")),
        ([("assistant", "kept"), None], ("kept", None)),
        ([("user", "x"), None], (None, "no_content")),
        ([], (None, "empty")),
        (None, (None, "empty")),
    ],
)
def test_struct_and_map_messages(spark, messages, expected):
    assert respond(spark, messages, STRUCTS) == expected
    as_maps = messages and [
        m and {k: v for k, v in zip(("role", "content"), m) if v is not None} for m in messages
    ]
    assert respond(spark, as_maps, MAPS) == expected


def test_string_passes_unchanged(spark):
    assert respond(spark, "", "string") == ("", None)
    assert respond(spark, " text ", "string") == (" text ", None)
    assert respond(spark, None, "string") == (None, "empty")


def test_message_without_content_field(spark):
    assert respond(spark, [("assistant",)], "array<struct<role:string>>") == (None, "no_content")


def test_content_that_is_not_text(spark):
    ddl = "array<struct<role:string,content:int>>"
    assert respond(spark, [("assistant", 7), ("assistant", 0)], ddl) == ("7", None)


def test_other_types_are_refused(spark):
    with pytest.raises(TypeError):
        respond(spark, 1, "int")


def preferences(spark):
    good = [("user", "q"), ("assistant", "a")]
    return spark.createDataFrame(
        [
            (1, "p1", good, good),
            (2, None, good, good),
            (3, "p3", [], good),
            (4, "p4", good, None),
            (5, "p5", good, [("user", "")]),
        ],
        f"id int, prompt string, chosen {STRUCTS}, rejected {STRUCTS}",
    )


def test_quarantine(spark):
    kept = preference_examples(preferences(spark)).collect()
    assert [tuple(r) for r in kept] == [(1, "p1", "a", "a")]
    reasons = {r["id"]: r["reason"] for r in invalid_preferences(preferences(spark)).collect()}
    assert reasons == {2: "null_prompt", 3: "empty", 4: "empty", 5: "no_content"}


def test_strict_mode_ends_the_job(spark):
    with pytest.raises(Exception, match="empty"):
        preference_examples(preferences(spark).where("id in (1, 3)"), strict=True).collect()
    assert preference_examples(preferences(spark).where("id = 1"), strict=True).count() == 1


def test_first_rows(spark):
    frame = spark.range(10).orderBy(F.desc("id"))
    assert [r["id"] for r in first_rows(frame, "id", 3).collect()] == [0, 1, 2]
    assert first_rows(frame, "id", None).count() == 10
