# -*- coding: utf-8 -*-
"""Text rules against hand-written cases and a character-level brute force."""

import random
import sys

import pytest

from vocatio import fixed_values as fixed
from vocatio.functions import text as rules

DUTY, NEGATIVE = fixed.DUTY_HEADERS, fixed.NEGATIVE_HEADERS
SPACES = [chr(c) for c in range(0x10000) if chr(c).isspace()]


# --- brute force --------------------------------------------------------------


def skip_spaces(text, at):
    while at < len(text) and text[at].isspace():
        at += 1
    return at


def marker_end(text, at):
    """(digits, end) of a number mark with its trailing blanks, or None."""
    end = at
    while end < len(text) and text[end].isdecimal():
        end += 1
    if end == at or text[end : end + 1] not in tuple(".、)）"):
        return None
    return text[at:end], skip_spaces(text, end + 1)


def slow_numbered(text):
    text = text.strip()
    if text in ("", "无法识别"):
        return text
    built, at = [], 0
    while at < len(text):
        mark = None
        if at and text[at - 1] != "\n":
            mark = marker_end(text, skip_spaces(text, at))
        built.append(text[at] if mark is None else f"\n{mark[0]}. ")
        at = at + 1 if mark is None else mark[1]
    done = []
    for line in "".join(built).splitlines():
        line = line.strip()
        mark = marker_end(line, 0)
        if mark:
            line = f"{mark[0]}. {line[mark[1]:]}"
        if line:
            done.append(line if line[-1] in "；;。.！!？?" else line + "；")
    return "\n".join(done)


def random_texts(pieces, n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(n)]


# --- whitespace ---------------------------------------------------------------


def test_whitespace_class_is_complete(ask):
    assert len(rules.WS_CHARACTERS) == len(SPACES) == 29
    assert set(rules.WS_CHARACTERS) == set(SPACES)
    texts = [f"a{c}b" for c in SPACES] + ["a\u200bb", "a\ufeffb", "a_b"]
    lengths = ask(rules.effective_length, texts)
    assert lengths == [2] * 29 + [3] * 3


def test_strip_and_collapse_follow_python(ask):
    texts = random_texts(SPACES + ["a", "岗", "b c"], 300, 1)
    assert ask(rules.strip, texts) == [t.strip() for t in texts]
    assert ask(rules.collapse_whitespace, texts) == [" ".join(t.split()) for t in texts]
    assert ask(rules.collapse_whitespace, [None]) == [""]


@pytest.mark.parametrize("minimum", [0, 1, 3, 30, 600])
def test_length_test_equals_counting(ask, minimum):
    texts = random_texts(SPACES + ["a", "岗", "😀", "bc" * 70], 200, minimum) + [None, ""]
    texts += ["x" * (minimum - 1), "x " * minimum, "\u3000" * 50]
    count = [len("".join((t or "").split())) for t in texts]
    assert ask(rules.effective_length, texts) == count
    assert ask(lambda c: rules.has_effective_length(c, minimum), texts) == [
        n >= minimum for n in count
    ]


# --- names, codes, texts ------------------------------------------------------


def test_year_from_name(ask):
    cases = {
        "recruitment_infos_content_2021": "2021",
        "a1999b2020": "1999",
        "x": "unknown",
        "": "unknown",
        "18992": "unknown",
        "120155": "2015",
    }
    assert ask(rules.year_from_name, list(cases)) == list(cases.values())


def test_level_codes(ask):
    cases = {
        "1-2-3-4": "1-02-03-04",
        " 1-2 ": "1-02",
        "1": "1",
        "01-2": "01-02",
        "12-34-56-78": "12-34-56-78",
        "1-2-3-4-5": "1-2-3-4-5",
        "123": "123",
        "1-": "1-",
        "abc": "abc",
        "  ": "",
        None: "",
    }
    assert ask(rules.normalize_level_code, list(cases)) == list(cases.values())


def test_occupation_text(spark):
    from pyspark.sql import functions as F

    rows = [
        ("a  b", "c\nd", "a b：c d"),
        (" a ", None, "a"),
        ("", "t", "t"),
        (None, "  ", ""),
    ]
    df = spark.createDataFrame(rows, "n string, t string, want string")
    for row in df.withColumn("got", rules.occupation_text(F.col("n"), F.col("t"))).collect():
        assert row["got"] == row["want"]


def test_invalid_input(ask):
    texts = ["x" * 9, "x" * 10, " 无法识别 ", None, "", "\u3000" + "x" * 9 + "\u3000", "x" * 5 + " " * 9]
    assert ask(rules.is_invalid_input, texts) == [True, False, True, True, True, True, True]
    assert ask(lambda c: rules.is_invalid_input(c, 2), ["无法识别", "", "ab"]) == [True, True, False]


# --- duties -------------------------------------------------------------------

DUTY_CASES = {
    "公司介绍：abc岗位职责：一、做事\n任职要求：x": "一、做事",
    "做饭\n任职要求：会做饭": "做饭",
    "任职要求：会做饭": "",
    "岗位职责：\n任职要求：x": "岗位职责：",
    "岗位职责：a\n岗位职责：b": "a\nb",
    "主要工作内容: 跑步\t游泳": "跑步 游泳",
    "岗位职责\n洗碗": "洗碗",
    "甲岗位职责\r\n洗碗\r扫地": "洗碗\n扫地",
    "岗位职责\u3000：洗碗": "洗碗",
    "福利待遇：好\n岗位职责：洗碗\n\n  扫地 \n福利待遇：双休\n岗位职责：做饭": "洗碗\n扫地",
    "  洗碗  \n\t扫地": "洗碗\n扫地",
    "任职要求：会\n岗位职责：洗碗任职要求：细心": "洗碗",
    "岗位职责：任职要求：x岗位职责：y": "岗位职责：",
    "工作职责:岗位职责：洗碗": "洗碗",
    "洗碗\r\n\r\n公司介绍\r\n大厂": "洗碗",
    "": "",
}


def test_duty_cases(ask):
    found = ask(rules.duty_section, list(DUTY_CASES))
    assert found == list(DUTY_CASES.values())


def test_duties_of_random_texts_keep_their_order(ask):
    """No kept line opens with a closing header, none is blank, and all stand in the text in this order."""
    pieces = DUTY + NEGATIVE + ["主要", "：", ":", "\n", "\r\n", "\r", "\t", " ", "\u3000", "a", "做饭;"]
    texts = random_texts(pieces, 1500, 7)
    several = 0
    for text, found in zip(texts, ask(rules.duty_section, texts)):
        lines = found.split("\n") if found else []
        several += len(lines) > 1
        assert all(line == line.strip() and line for line in lines)
        assert not any(line.startswith(tuple(NEGATIVE)) for line in lines)
        left = iter("".join(text.split()))
        assert all(c in left for c in "".join(found.split()).replace("：", "").replace(":", ""))
    assert several > 100


def test_duty_text_falls_back_and_prompt_truncates(ask):
    assert ask(rules.duty_text, [" 任职要求：会 ", None]) == ["任职要求：会", ""]
    whole = ask(rules.duty_text, ["岗位职责：" + "长" * 3000])[0]
    assert whole == "长" * 3000
    built = ask(lambda c: rules.prompt(c, "<", ">"), ["岗位职责：" + "长" * 3000])[0]
    assert built == "<" + "长" * fixed.MAX_INPUT_CHARS + ">"


def test_prompt_texts():
    system, user = rules.prompt_texts(["甲", "乙"])
    assert system == fixed.SYSTEM_PROMPT
    assert "示例1：甲\n示例2：乙\n" in user and "{" not in user
    assert fixed.NO_EXAMPLES in rules.prompt_texts([])[1]


# --- numbered lists -----------------------------------------------------------

NUMBERED_CASES = {
    "1.abc；2.def": "1. abc；\n2. def；",
    "10. abc 11) de": "1；\n0. abc；\n11. de；",
    "工资3.5万": "工资；\n3. 5万；",
    "1、甲\n2、乙\n\n10）丙": "1. 甲；\n2. 乙；\n10. 丙；",
    " 无法识别 ": "无法识别",
    "": "",
    "无": "无；",
}


def test_numbered_cases(ask):
    found = ask(rules.format_numbered, list(NUMBERED_CASES))
    assert found == list(NUMBERED_CASES.values())
    assert [slow_numbered(t) for t in NUMBERED_CASES] == found


@pytest.mark.parametrize("mark", list("；;。.！!？?"))
def test_closing_marks_are_kept(ask, mark):
    assert ask(rules.format_numbered, ["做饭" + mark]) == ["做饭" + mark]


def test_numbered_equal_brute_force(ask):
    pieces = list("0123456789") + list(".、)）；。!") + ["\n", " ", "\u3000", "\u2028", "\x1c", "a", "职", "٣"]
    texts = random_texts(pieces, 2500, 3)
    assert ask(rules.format_numbered, texts) == [slow_numbered(t) for t in texts]


def test_python_has_the_expected_whitespace():
    assert sys.version_info >= (3, 9) and "\x1c".isspace() and not "\u200b".isspace()
