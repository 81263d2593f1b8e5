from tintwell.operators import annotation

EVENTS = "event_id string, item_id string, annotator_id string, kind string, value string, created_at int, supersedes_event_id string"


def frames(spark):
    events = [("e1", "i1", "ann", "role", "x", 1, None), ("e2", "i1", "ann", "role", "y", 2, "e1"), ("e3", "i1", "ann", "revoke", None, 3, "e2"), ("e4", "i2", "ann", "role", "x", 1, None), ("e5", "i2", "bob", "role", "x", 2, None), ("e6", "i2", "ann", "eligibility", "1", 3, None), ("e7", "i3", "ann", "occurrence_relation", "r", 3, None)]
    items = [("i1", "s", False, False), ("i2", "s", True, False), ("i3", "s", False, True), ("i4", "s", False, False)]
    return spark.createDataFrame(events, EVENTS), spark.createDataFrame(items, "item_id string, set_id string, blind boolean, occurrence boolean")


def test_append_rules(spark):
    events, items = frames(spark)
    new = [
        ("n1", "i1", "ann", "role", "z", 9, "e1", None),
        ("n2", "i1", "ann", "role", "z", 9, "e2", "supersedes_not_latest"),
        ("n3", "i2", "eve", "role", "z", 9, None, None),
        ("n4", "i2", "ann", "role", "z", 9, None, "revision_without_reference"),
        ("n5", "i1", "ann", "revoke", None, 9, "e2", "already_revoked"),
        ("n6", "i1", "ann", "revoke", None, 9, "e4", "revoke_target_not_on_item"),
        ("n7", "i1", "ann", "revoke", None, 9, None, "revoke_names_no_event"),
        ("n8", "i1", "ann", "revoke", None, 9, "e1", None),
        ("n9", "i9", "ann", "role", "z", 9, None, "unknown_item"),
        ("na", "i4", "ann", "mask2", "z", 9, None, "unknown_kind"),
        ("nb", "i4", "ann", "role", "z", 9, None, None),
        ("nc", "i4", "ann", "role", "z", 10, None, "one_at_a_time"),
    ]
    # n1 and n2 are for one item and kind; both are judged, and the first of them alone is free of problems.
    got = {r.event_id: r.problem for r in annotation.append_problems(events, items, spark.createDataFrame([n[:7] for n in new], EVENTS)).collect()}
    assert got == {n[0]: n[7] for n in new}


def test_status_and_progress(spark):
    events, items = frames(spark)
    got = {r.item_id: r.status for r in annotation.item_status(items, events).collect()}
    assert got == {"i1": "in_progress", "i2": "in_progress", "i3": "completed", "i4": "pending"}
    r = annotation.progress(items, events).first()
    assert r.item_status == {"completed": 1, "in_progress": 2, "pending": 1} and r.event_types["role"] == 4


def test_latest_live(spark):
    events, items = frames(spark)
    got = {(r.item_id, r.kind, r.scope): r.event_id for r in annotation.latest_live(events, items).collect()}
    assert got[("i1", "role", "")] == "e1" and got[("i2", "role", "ann")] == "e4" and got[("i2", "role", "bob")] == "e5"


def test_leaks(spark):
    df = spark.createDataFrame([("g1", "train"), ("g1", "test"), ("g2", "train"), ("g2", "train")], "group_id string, split string")
    assert [tuple(r) for r in annotation.leaking_split_pairs(df).collect()] == [("test", "train", 1)]
