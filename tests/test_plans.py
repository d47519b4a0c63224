"""Queries over small tables made for them."""

from lexquarry.plans import record_plans, text_plans


def save(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_status_changes_of_every_part(spark, tmp_path):
    save(spark, tmp_path, "code_articles", [(1, 2), (2, 4), (3, 300)], "rec_id long, article_number int")
    parts = [(1, 1, "b", "t"), (3, 0, "b", "t"), (387, 0, "b", "t")]
    at = save(spark, tmp_path, "part", parts, "p_partkey long, p_size int, p_brand string, p_type string")
    got = {tuple(r) for r in record_plans.status_interval_join(spark, at).collect()}
    assert got == {(1, 2, 1, 1), (2, 4, 3, 0)}
    rolled = {tuple(r) for r in record_plans.status_roll_up(spark, at).collect()}
    assert rolled == {(2, "partly_superseded", 1), (4, "superseded", 1), (300, "no_change_noted", 0)}


def test_page_quality_of_whole_pages(spark, tmp_path):
    pages = [(120, "x" * 1300), (121, "y" * 50), (122, "z" * 49), (123, " \n\t"), (124, ""), (125, None), (240, " " * 200 + "w" * 60)]
    at = save(spark, tmp_path, "scan_pages", pages, "page_id long, raw_text string")
    got = {r.page_id: r.warning for r in text_plans.page_quality(spark, at).collect()}
    assert got == {120: None, 121: None, 122: "low_char_count", 123: "empty_page", 124: "empty_page", 125: None, 240: None}


def test_nested_items_of_scanned_sections(spark, tmp_path):
    sections = [(i, "(a) one\n(b) two", ocr) for i, ocr in enumerate((True, None, False))]
    at = save(spark, tmp_path, "order_sections", sections, "rec_id long, content string, ocr_text boolean")
    got = sorted((r.rec_id, r.path) for r in text_plans.nested_items(spark, at).collect())
    assert got == [(i, p) for i in range(3) for p in "ab"]
