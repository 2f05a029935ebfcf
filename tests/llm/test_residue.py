"""Template residue and messages."""

import pytest

from loomery.llm.residue import find, residue


@pytest.mark.parametrize("t", ["{{title}}", "Work {{ comic.name }}", "${bookName}", "<%= work.label %>", "&lt;%= caption %&gt;", "%(series)s", "Ch. %d", "__PAGE_TITLE__", "[[entry]]", ":title:", "@Model.Caption", "{#}".replace("#", "0"), "第${idx}章"])
def test_placeholders(t):
    assert residue(t) == "placeholder"


@pytest.mark.parametrize("t", ["undefined", "Chapter null", "第NaN話", "[object Object]", "Chapter [object Object]"])
def test_unset(t):
    assert residue(t) == "unset"


@pytest.mark.parametrize("t", ["Error 503", "HTTP 404", "404 Not Found", "  Page not found\n", "页面不存在", "请启用JAVASCRIPT后继续浏览", "ページが見つかりません", "서버 오류가 발생했습니다", "Seite nicht gefunden", "Lorem ipsum dolor sit amet", "Just a moment...", "Chapter lorem ipsum", "Code 502, see the log", "Внутренняя ошибка сервера"])
def test_messages(t):
    assert residue(t) == "message"


@pytest.mark.parametrize("t", [None, "", "  ", "Chapter 12: The Man Named Undefined", "The Null Prince of Kumasaro", "Error of Youth", "不存在的山山山山传说", "404号房间与山山山山的约定", "100% Dova Gege", "<3 for Babababa", "[ Wenn der Garten erwacht ]", "正在加载人生的人", "Access to Babababa Denied by Love", "Chapter 5", "Java Script Calligraphers of Nubijogi", "x" * 100_000])
def test_works_stay(t):
    assert residue(t) is None


def test_find(spark):
    df = spark.createDataFrame([(1, "detail_title", "null"), (1, "first_chapter_title", "One"), (2, "detail_title", None), (3, "detail_title", "null")], "audit_id long, field string, text string")
    assert sorted((r.audit_id, r.field) for r in find(df).collect()) == [(1, "detail_title"), (3, "detail_title")]
    assert find(df.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["{{" + "x" * 5000 + "}}", "a <% " + "y " * 5000 + "%> b", "${" + "z" * 500 + "}", "[[" + "w" * 500 + "]]", "&lt;? " + "q" * 400 + " ?&gt;", "<?php " + "echo " * 900])
def test_placeholders_of_any_length(text):
    assert residue(text) == "placeholder"


@pytest.mark.parametrize("mark", ["{{", "{%", "<%", "[[", "${", "&lt;?", ":a", "{a", "$$a", "__A"])
def test_marks_without_end_in_linear_time(mark):
    import time

    began = time.time()
    residue(mark * 200_000)
    assert time.time() - began < 5


@pytest.mark.parametrize("text", ["404 Seite konnte nicht gefunden werden", "Cette page n'existe plus", "Página não encontrada", "Your session has expired", "Lütfen JavaScript'i etkinleştirin", "Attiva JavaScript per continuare", "Vui lòng bật JavaScript để tiếp tục", "Strona nie została znaleziona", "الصفحة غير موجودة"])
def test_messages_in_more_languages(text):
    assert residue(text) == "message"
