"""Every validation rule on hand-built events (P-1 .. P-4)."""

import json

from relayplan import constants as K
from relayplan.operators.validate import validate_requests
from relayplan.sources import events as EV


def event(**over):
    e = {"id": "1", "EventBusName": K.EVENT_BUS_NAME, "Source": "manual", "DetailType": K.DETAIL_TYPE,
         "Detail": {"payload": {"sourceUriList": ["icav2://p/a/"], "destinationUri": "icav2://q/b/"},
                    "taskToken": "tok"}}
    for path, value in over.items():
        node = e
        keys = path.split(".")
        for k in keys[:-1]:
            node = node[k]
        if value is None:
            node.pop(keys[-1], None)
        else:
            node[keys[-1]] = value
    return e


CASES = {
    1: ({}, set()),
    2: ({"EventBusName": "Other"}, {("EventBusName", "enum")}),
    3: ({"EventBusName": None}, {("EventBusName", "required")}),
    4: ({"Source": ""}, {("Source", "minLength")}),
    5: ({"Source": None}, {("Source", "required")}),
    6: ({"DetailType": "X"}, {("DetailType", "enum")}),
    7: ({"Detail": None}, {("Detail", "required")}),
    8: ({"Detail.payload": None}, {("Detail.payload", "required")}),
    9: ({"Detail.taskToken": None}, {("Detail.taskToken", "required")}),
    10: ({"Detail.taskToken": ""}, {("Detail.taskToken", "minLength")}),
    11: ({"Detail.payload.sourceUriList": []}, {("Detail.payload.sourceUriList", "minItems")}),
    12: ({"Detail.payload.sourceUriList": None}, {("Detail.payload.sourceUriList", "required")}),
    13: ({"Detail.payload.sourceUriList": ["icav2://p/a/", "s3://my.bucket/k", ""]},
         {("Detail.payload.sourceUriList[1]", "pattern"), ("Detail.payload.sourceUriList[2]", "pattern"),
          ("Detail.payload.sourceUriList[2]", "minLength")}),
    14: ({"Detail.payload.destinationUri": "icav2://q/b"}, {("Detail.payload.destinationUri", "endsWithSlash")}),
    15: ({"Detail.payload.destinationUri": ""}, {("Detail.payload.destinationUri", "minLength")}),
    16: ({"Detail.payload.destinationUri": None}, {("Detail.payload.destinationUri", "required")}),
    17: ({"Detail.payload.externalSourceUriList": ["s3://b/k", "gs://b/k"]},
         {("Detail.payload.externalSourceUriList[1]", "pattern")}),
    18: ({"Detail.payload.renamingMapList": [
            {"sourceUri": "icav2://p/a/f", "outputFileName": "x"},          # ok
            {"dataId": "fil.1", "outputFileName": "x"},                       # ok
            {"sourceUri": "icav2://p/a/f", "dataId": "fil.1", "outputFileName": "x"},  # both: oneOf
            {"outputFileName": "x"},                                          # neither: oneOf
            {"sourceUri": "s3://my.bucket/k", "outputFileName": "x"},        # bad URI: oneOf
            {"dataId": "fil.1", "outputFileName": ""},                        # empty name
            {"dataId": "fil.1"}]},                                            # no name
         {("Detail.payload.renamingMapList[2]", "oneOf"), ("Detail.payload.renamingMapList[3]", "oneOf"),
          ("Detail.payload.renamingMapList[4]", "oneOf"), ("Detail.payload.renamingMapList[5]", "outputFileName"),
          ("Detail.payload.renamingMapList[6]", "outputFileName")}),
    19: ({"Detail.payload.sourceUriList": ["icav2://p/f.txt"]}, set()),   # no right anchor: passes
}


def test_each_rule(spark):
    rows = [(i, json.dumps(event(**over))) for i, (over, _) in CASES.items()]
    df = EV.parse_requests(spark.createDataFrame(rows, "request_id long, body string"))
    got = {}
    for r in validate_requests(df).collect():
        got.setdefault(r.request_id, set()).add((r.field, r.rule))
    for i, (_, want) in CASES.items():
        assert got.get(i, set()) == want, i
