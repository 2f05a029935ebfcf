"""Every p-query over empty tables, and over tables of nulls, blanks, very long texts and repeated rows with extra columns of clashing names."""

import pytest

from loomery.llm import queries as Q
from loomery.operators import queries as C

CLASH = ["src", "field", "text", "plain", "host", "label", "h", "canon", "rank", "cap", "ids", "gram", "score", "passages", "path", "item", "row_id", "chain"]
TABLES = {
    "page_audit": "audit_id bigint, run_id bigint, domain string, base_url string, detail_url string, detail_title string, cover_url string, chapter_count bigint, first_chapter_title string, first_chapter_url string, static_image_count bigint, first_image_url string, needs_render_fallback boolean, requires_login_or_pay boolean, status string, evidence struct<candidatetitle:string,candidatesnippet:string,engine:string,keyword:string>, lang string, audited_at timestamp_ntz, ingested_at timestamp_ntz",
    "candidate": "ordinal bigint, run_id bigint, url string, title string, snippet string, engine string, lang string, found_at timestamp_ntz, ingested_at timestamp_ntz",
    "rulebot_report": "report_id bigint, run_id bigint, lang string, received_at timestamp_ntz, body string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint, doc_type string, page_url string, written_at timestamp_ntz, crawled_at timestamp_ntz",
    "doc_rating": "doc_id bigint, rater string, unsafe int, note string",
    "eval_item": "item_id bigint, lang string, task string, text string",
}
P = {**Q.QUERIES, **{n: f for n, f in C.QUERIES.items() if n.startswith("p5_")}}


def write(spark, folder, rows_of):
    for name, ddl in TABLES.items():
        clash = [c for c in CLASH if f"{c} " not in f"{ddl} "]
        spark.createDataFrame(rows_of(name, clash), ddl + "".join(f", {c} string" for c in clash)).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), lambda name, clash: [])


LONG = "The art is clean and every panel gives the kite room to breathe. " * 4000


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    def rows(name, clash):
        x = ["x"] * len(clash)
        values = [None, "", "   ", LONG, "{{title}}", "Julі Lalo", "Cap\xc3\xadtulo 5", "Die letzte Nacht der Stadt", "Die letzte Nacht der Stadt"]
        if name == "page_audit":
            return [(i + 1, None, None, None, None, v, None, None, v, None, None, None, None, None, None, None, None, None, None, *x) for i, v in enumerate(values)]
        if name == "candidate":
            return [(i + 1, None, None, v, v, None, None, None, None, *x) for i, v in enumerate(values)]
        if name == "rulebot_report":
            return [(i + 1, None, None, None, v, *x) for i, v in enumerate([*values, '{"generated": [{}]}', '{"generated": [{}]}'])]
        if name == "documents":
            return [(i + 1, v, None, None, None, None, None, None, None, *x) for i, v in enumerate(values)]
        if name == "doc_rating":
            return [(None, None, 1, None, *x), (4, None, None, None, *x), (8, "r", 0, None, *x), (8, "r", 0, None, *x), (99, "r", 1, "x", *x)]
        return [(i + 1, None, None, v, *x) for i, v in enumerate(values)]

    return write(spark, tmp_path_factory.mktemp("odd"), rows)


@pytest.mark.parametrize("name", sorted(P))
def test_empty(spark, empty, name):
    assert P[name](spark, empty).count() == 0


WANT = {
    "p1_found": {("candidate", 6), ("page_audit", 6)}, "p2_found": {(5, "detail_title"), (5, "first_chapter_title")}, "p3_found": set(), "p4_found": {("candidate", 8, 9), ("page_audit", 8, 9)},
    "p5_found": {(10, "generated", 0, -1, ""), (11, "generated", 0, -1, "")}, "p6_found": {("page_audit", 7, "detail_title"), ("page_audit", 7, "first_chapter_title"), ("candidate", 7, "snippet")},
    "p9_found": {(4, 4)}, "p10_found": set(),
}


@pytest.mark.parametrize("name", sorted(P))
def test_odd(spark, odd, name):
    got = {tuple(r) for r in P[name](spark, odd).collect()} if name in WANT else P[name](spark, odd).count()
    if name == "p2_found":
        got = {g for g in got if g[0] == 5}
    if name in WANT:
        assert got == WANT[name]
