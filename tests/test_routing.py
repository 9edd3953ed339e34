import json

import pytest

from silverbrook.functions.events import entity_key
from silverbrook.operators.routing import route_events, validate_events

GOOD = {"specversion": "1.0", "id": "1", "source": "//s", "type": "com.example.order.upsert"}
TEXT = json.dumps(GOOD)


def _validate(spark, *texts):
    return validate_events(spark.createDataFrame([(t,) for t in texts], "value string"))


def _all_errors(spark, *texts):
    """The errors of every text, in one job."""
    valid, rejected = _validate(spark, *texts)
    found = {r["value"]: [(e["field"], e["message"]) for e in r["errors"]] for r in rejected.collect()}
    assert valid.count() + len(found) == len(set(texts))
    return [found.get(text, []) for text in texts]


def _errors(spark, text):
    return _all_errors(spark, text)[0]


def test_required_attributes(spark):
    texts, expected = [], []
    for field in ("specversion", "id", "source", "type"):
        texts.append(json.dumps({k: v for k, v in GOOD.items() if k != field}))
        expected.append([(field, "Field required")])
        for value in (None, 5, 1.0, True, [], {}):
            texts.append(json.dumps({**GOOD, field: value}))
            expected.append([(field, "Input should be a valid string")])
    assert _all_errors(spark, *texts) == expected


def test_blank_text(spark):
    texts, expected = [], []
    for field in ("id", "source", "type"):
        for blank in ("", "   ", "\t\n", "\u00a0", "\u3000", "\x1c"):
            texts.append(json.dumps({**GOOD, field: blank}))
            expected.append([(field, f"Value error, '{field}' must be a non-empty string")])
    assert _all_errors(spark, *texts) == expected


def test_version(spark):
    versions = ["0.3", "1.0 ", "1", "it's"]
    texts = [json.dumps({**GOOD, "specversion": v}) for v in versions]
    message = "Value error, unsupported specversion: {!r} — expected '1.0'"
    assert _all_errors(spark, *texts) == [[("specversion", message.format(v))] for v in versions]


def test_errors_come_in_order(spark):
    text = json.dumps({"specversion": "2", "id": " ", "type": 7})
    assert [f for f, _ in _errors(spark, text)] == ["specversion", "id", "source", "type"]


def test_not_one_json_value(spark):
    texts = [
        "not-json{{{{", TEXT + " x", TEXT + "] {}", TEXT + "} {}", TEXT + "," + TEXT, TEXT + TEXT,
        TEXT + ', "w": 1', TEXT[:-1], "  ",
    ]
    assert _all_errors(spark, *texts) == [[(None, "invalid JSON body")]] * len(texts)


def test_not_an_object(spark):
    texts = ["[1]", "5", '"text"', "null", f"[{TEXT}]"]
    assert _all_errors(spark, *texts) == [[(None, "request body must be a JSON object")]] * len(texts)


@pytest.mark.parametrize("text", ["", None])
def test_empty_body_lacks_everything(spark, text):
    assert len(_errors(spark, text)) == 4


def test_acceptable_events_keep_extras(spark):
    nested = {
        **GOOD,
        "subject": "user/u-1",
        "extra": 1,
        "data": {"order_id": "o-1", "customer": {"tier": "gold"}, "items": [{"sku": "S", "qty": 2}]},
    }
    valid, rejected = _validate(spark, TEXT, json.dumps(nested), f"\n {TEXT}\n")
    assert rejected.count() == 0
    row = valid.filter("ce_subject is not null").selectExpr(
        "ce_id", "ce_subject", "variant_get(record_content, '$.data.items[0].qty', 'int') q",
        "variant_get(record_content, '$.extra', 'int') x",
    ).first()
    assert tuple(row) == ("1", "user/u-1", 2, 1)


def test_repeated_key_keeps_the_last(spark):
    text = TEXT[:-1] + ', "id": "2"}'
    assert _validate(spark, text)[0].first()["ce_id"] == "2"


def test_routes_are_disjoint_and_complete(spark, rows):
    df = spark.createDataFrame([("ecommerce_clicks",), ("ecommerce_clicks.x",), ("a.b",), (None,)], "ce_type string")
    landing, stored = route_events(df)
    assert rows(landing) == [("ecommerce_clicks",)]
    assert stored.count() == 3


def test_entity_key(spark, rows):
    df = spark.createDataFrame([("a.b.upsert",), ("a",), ("a.b.",), ("",)], "t string")
    keys = dict(rows(df.select("t", entity_key("t"))))
    assert keys == {"a.b.upsert": "a.b", "a": "", "a.b.": "a.b", "": ""}


def test_each_text_is_parsed_once(spark, folder):
    spark.createDataFrame([(TEXT,)], "value string").write.text(f"{folder}/t")
    valid, _ = validate_events(spark.read.text(f"{folder}/t"))
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1
