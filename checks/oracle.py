# -*- coding: utf-8 -*-
"""DuckDB counterparts of the registered queries.

Written as SQL over the given tables, independent of the Spark expressions.
The tables hold ASCII whitespace only, so RE2's ``\\s`` is enough here.
"""

from __future__ import annotations

from checks import views
from vocatio import fixed_values as fixed


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def with_ctes(ctes: dict[str, str], final: str) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {body}\n{final}"


# --- postings and cleaning ----------------------------------------------------

POSTINGS = """
  SELECT doc_id AS ord, md5(text) AS rec_id, text AS position_responsibilities,
         CAST(2015 + n_chars % 10 AS VARCHAR) AS year, lang AS origin FROM documents
  UNION ALL
  SELECT turn, 'c' || CAST(conv_id AS VARCHAR), text,
         CAST(2015 + conv_id % 10 AS VARCHAR), role FROM conversations"""

EFFECTIVE_LEN = r"length(regexp_replace(position_responsibilities, '\s+', '', 'g'))"

FIRSTS = """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY year, rec_id ORDER BY ord) AS n
                 FROM postings) WHERE n = 1"""

CLEAN = f"SELECT * EXCLUDE (n) FROM firsts WHERE {EFFECTIVE_LEN} >= 30"

CLEANING = {"postings": POSTINGS, "firsts": FIRSTS, "clean": CLEAN}


# --- duty sections ------------------------------------------------------------


def split_lines(text: str) -> str:
    text = f"replace(replace(replace({text}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(9), ' ')"
    for header in fixed.DUTY_HEADERS + fixed.NEGATIVE_HEADERS:
        text = (
            rf"regexp_replace({text}, '(^|[^\n]){header}\s*[:：]?', "
            rf"'\1' || chr(10) || '{header}：', 'g')"
        )
    return (
        f"list_filter(list_transform(string_split({text}, chr(10)), "
        f"lambda l: {strip('l')}), lambda l: l <> '')"
    )


def strip_duty_headers(line: str) -> str:
    for header in fixed.DUTY_HEADERS:
        line = rf"regexp_replace({line}, '^\s*{header}\s*[:：]?\s*', '')"
    return strip(line)


def starts_with(words: list[str]) -> str:
    return f"'^({'|'.join(words)})'"


def duty_ctes(source: str, key: str, text: str) -> dict[str, str]:
    """CTEs ending in ``duties(key, raw, duty)`` for the texts of ``source``."""
    opens, closes = starts_with(fixed.DUTY_HEADERS), starts_with(fixed.NEGATIVE_HEADERS)

    def flags(lines: str, pattern: str) -> str:
        return f"list_transform({lines}, lambda l: regexp_matches(l, {pattern}))"

    def head(lines: str) -> str:
        stop = f"coalesce(nullif(list_position({flags(lines, closes)}, true), 0), len({lines}) + 1)"
        return f"list_slice({lines}, 1, CAST({stop} - 1 AS BIGINT))"

    return {
        "stripped": f"SELECT {key}, {strip(text)} AS raw FROM {source}",
        "lined": f"SELECT {key}, raw, {split_lines('raw')} AS lines FROM stripped",
        "started": f"""SELECT *, coalesce(list_position({flags('lines', opens)}, true), 0) AS start
                       FROM lined""",
        "sections": f"""
          SELECT *, list_filter(list_transform({head('list_slice(lines, greatest(start, 1), len(lines))')},
                      lambda l: {strip_duty_headers('l')}), lambda l: l <> '') AS found
          FROM started""",
        "duties": f"""
          SELECT {key}, raw, CASE WHEN duty <> '' THEN duty ELSE raw END AS duty FROM (
            SELECT {key}, raw, array_to_string(CASE WHEN start > 0 AND len(found) > 0 THEN found
                   ELSE {head('lines')} END, chr(10)) AS duty FROM sections)""",
    }


HEADED = """
  SELECT doc_id, CASE lang
    WHEN 'en' THEN '公司介绍：' || source || '岗位职责：' || text || chr(10) || '任职要求：' || source
    WHEN 'fr' THEN text || '主要工作内容: ' || text
    WHEN 'de' THEN '工作职责' || chr(10) || '任职要求: ' || text
    ELSE text || chr(13) || chr(10) || '福利待遇' || chr(9) || text END AS raw
  FROM documents"""


# --- numbered lists -----------------------------------------------------------


def numbered(text: str, renumbered: bool = False) -> str:
    """Number formatting without look-behind.

    A mark opens a line unless it is at the start of the text, where only the
    first digit is exempt, or the line break before it was taken by a mark that
    ends the line above. The second case needs a line that starts with a
    number, which occurs only in texts that were ``renumbered`` from 1.
    """
    text = strip(text)
    broken = rf"regexp_replace({text}, '^([0-9])([0-9]*[.、)）])', '\1' || chr(2) || '\2')"
    if renumbered:
        broken = (
            rf"regexp_replace({broken}, '([0-9]+[.、)）])\s*\n([1-5])\. ', "
            rf"'\1' || chr(10) || chr(2) || '\2' || chr(2) || '. ', 'g')"
        )
    broken = rf"regexp_replace({broken}, '\s*([0-9]+)[.、)）]\s*', chr(10) || '\1. ', 'g')"
    lines = rf"regexp_split_to_array(replace({broken}, chr(2), ''), '[\n\r]')"
    lines = f"list_filter(list_transform({lines}, lambda l: {strip('l')}), lambda l: l <> '')"
    item = r"regexp_replace(l, '^([0-9]+)[.、)）]\s*', '\1. ')"
    ended = f"""list_transform(list_transform({lines}, lambda l: {item}),
                lambda l: CASE WHEN regexp_matches(l, '[；;。.！!？?]$') THEN l ELSE l || '；' END)"""
    return (
        f"CASE WHEN {text} IN ('', '无法识别') THEN {text} "
        f"ELSE array_to_string({ended}, chr(10)) END"
    )


NUMBERED = """
  SELECT doc_id, CASE lang
    WHEN 'es' THEN '10. ' || text
    WHEN 'fr' THEN '1、' || text || '。2）' || source
    ELSE '1) ' || text || ' 12.  ' || source || '!' END AS raw
  FROM documents"""


def rule_based(duty: str) -> str:
    pieces = rf"""list_filter(list_transform(regexp_split_to_array({duty}, '[\n；;。]'),
        lambda p: {strip(r"regexp_replace(p, '^\s*[0-9]+[.、)）]', '')")}), lambda p: p <> '')"""
    listed = f"""array_to_string(list_transform(list_slice({pieces}, 1, 5),
        lambda p, i: CAST(i AS VARCHAR) || '. ' || p), chr(10))"""
    return f"coalesce(nullif({listed}, ''), '无法识别')"


def rule_based_ctes(source: str, key: str, text: str) -> dict[str, str]:
    """CTEs ending in ``standardized(key, standardized, ok)``."""
    return {
        **duty_ctes(source, key, text),
        "answered": f"""SELECT {key}, CASE WHEN raw = '' THEN '' ELSE {rule_based('duty')} END AS answer
                        FROM duties""",
        "formatted": f"SELECT {key}, {numbered('answer', renumbered=True)} AS standardized FROM answered",
        "standardized": f"""SELECT *, standardized NOT IN ('', '无法识别') AS ok FROM formatted""",
    }


# --- codes and texts of the dictionary ----------------------------------------

RAW_CODES = r"""
  SELECT p_partkey, CASE p_type
    WHEN 'ECONOMY' THEN concat_ws('-', p_size, b, k)
    WHEN 'LARGE' THEN ' ' || p_size || chr(9)
    WHEN 'MEDIUM' THEN concat_ws('-', p_size, b, k, b)
    WHEN 'PROMO' THEN concat_ws('-', p_size, b, k, b, p_size)
    WHEN 'SMALL' THEN concat_ws('-', 'x', p_size)
    ELSE concat_ws('-', p_partkey, b) END AS raw
  FROM (SELECT *, regexp_extract(p_brand, '[0-9]+') AS b, p_partkey % 100 AS k FROM part)"""


def level_code(raw: str) -> str:
    code = strip(raw)
    padded = f"""array_to_string(list_transform(string_split({code}, '-'),
        lambda p, i: CASE WHEN i = 1 THEN p ELSE lpad(p, 2, '0') END), '-')"""
    return (
        f"CASE WHEN regexp_matches({code}, '^[0-9]{{1,2}}(-[0-9]{{1,2}}){{0,3}}$') "
        f"THEN {padded} ELSE {code} END"
    )


def collapsed(text: str) -> str:
    return rf"trim(regexp_replace(coalesce({text}, ''), '\s+', ' ', 'g'))"


NAMES_AND_TASKS = """
  SELECT p_partkey,
    CASE WHEN p_type = 'SMALL' THEN '' ELSE '  ' || p_name || chr(10) END AS name,
    CASE WHEN p_type IN ('LARGE', 'SMALL') THEN NULL
         ELSE p_brand || ' ' || chr(9) || ' ' || p_type END AS task
  FROM part"""


def joined_text(name: str, task: str) -> str:
    return (
        f"CASE WHEN {collapsed(name)} <> '' AND {collapsed(task)} <> '' "
        f"THEN {collapsed(name)} || '：' || {collapsed(task)} "
        f"ELSE {collapsed(name)} || {collapsed(task)} END"
    )


# --- vectors and matching -----------------------------------------------------

_MEANS = ", ".join(
    f"CAST(round(avg(CAST(embedding[{i}] AS DOUBLE)), 6) AS FLOAT)"
    for i in range(1, views.VECTOR_SIZE + 1)
)
_WORDS = "[" + ", ".join(quoted(words) for words in views.TASK_WORDS) + "]"
_TWO = "lpad(CAST({} AS VARCHAR), 2, '0')".format

OCCUPATIONS = f"""
  SELECT occ_idx, 'occ ' || occ_idx AS Level4_Name,
         {_WORDS}[CAST(label % 4 + 1 AS BIGINT)] || ' ' || occ_idx AS main_task,
         c1 AS Level1_Code, c2 AS Level2_Code, c3 AS Level3_Code, c4 AS Level4_Code,
         'class ' || r1 AS Level1_Name, 'group ' || r2 AS Level2_Name,
         'family ' || r3 AS Level3_Name, v
  FROM (SELECT *, label * 16 + bucket AS occ_idx,
          CAST(label % 8 + 1 AS VARCHAR) AS r1,
          concat_ws('-', label % 8 + 1, bucket % 4 + 1) AS r2,
          concat_ws('-', label % 8 + 1, bucket % 4 + 1, label + 1) AS r3,
          CAST(label % 8 + 1 AS VARCHAR) AS c1,
          concat_ws('-', label % 8 + 1, {_TWO('bucket % 4 + 1')}) AS c2,
          concat_ws('-', label % 8 + 1, {_TWO('bucket % 4 + 1')}, {_TWO('label + 1')}) AS c3,
          concat_ws('-', label % 8 + 1, {_TWO('bucket % 4 + 1')}, {_TWO('label + 1')},
                    {_TWO('bucket + 1')}) AS c4
        FROM (SELECT label, vec_id % {views.BUCKETS} AS bucket,
                     CAST([{_MEANS}] AS DOUBLE[]) AS v FROM embeddings GROUP BY ALL))"""

JOBS = """
  SELECT doc_id, CAST(2015 + n_chars % 10 AS VARCHAR) AS year,
         text AS standardized_job_description, CAST(embedding AS DOUBLE[]) AS q
  FROM documents LEFT JOIN embeddings
    ON vec_id = doc_id % (SELECT count(*) FROM embeddings)"""


def is_invalid(text: str) -> str:
    return f"({strip(text)} = '无法识别' OR length({strip(text)}) < 10)"


def norm(vector: str) -> str:
    return f"sqrt(list_dot_product({vector}, {vector}))"


def search_ctes(key: str = "doc_id", k: int = 10) -> dict[str, str]:
    """CTEs over ``jobs`` and ``occ`` ending in ``top(key, rank, occ_idx, score)``."""
    return {
        "valid_jobs": f"""SELECT {key}, q, {norm('q')} AS nq FROM jobs
                          WHERE NOT {is_invalid('standardized_job_description')}
                            AND q IS NOT NULL""",
        "keys": f"SELECT occ_idx, v, {norm('v')} AS nv FROM occ",
        "scored": f"""SELECT {key}, occ_idx, round(CASE WHEN nq = 0 OR nv = 0 THEN 0.0
                        ELSE list_dot_product(q, v) / (nq * nv) END, 6) AS score
                      FROM valid_jobs, keys""",
        "top": f"""SELECT * FROM (SELECT {key}, occ_idx, score, row_number() OVER (
                     PARTITION BY {key} ORDER BY score DESC, occ_idx) AS rank FROM scored)
                   WHERE rank <= {k}""",
    }


def decision_ctes(
    carried: str,
    key: str = "doc_id",
    min_score: float = 0.55,
    rules: dict[str, list[str]] | None = None,
    rerank: tuple[float, float] | None = None,
) -> dict[str, str]:
    """CTEs ending in ``matched``: ``carried`` columns of ``jobs`` + 14 columns.

    ``rerank`` is (threshold, minimum embed score).
    """
    listed = " UNION ALL ".join(
        f"SELECT {quoted(name)} AS occupation, [{', '.join(map(quoted, words))}] AS keywords"
        for name, words in (rules or {"": [""]}).items()
    )
    ctes = {"rules": listed}
    if rerank:
        threshold, minimum = rerank
        gate = max(min_score, minimum)
        text = joined_text("Level4_Name", "main_task")
        ctes |= {
            "eligible": f"""SELECT {key}, list_distinct(string_split(standardized_job_description, ' ')) AS a
                            FROM jobs WHERE {key} IN
                              (SELECT {key} FROM top WHERE rank = 1 AND score >= {gate})""",
            "cand_words": f"SELECT occ_idx, list_distinct(string_split({text}, ' ')) AS b FROM occ",
            # Words of each text once, then candidates meet them by word: a join instead of list work per pair.
            "text_words": f"SELECT {key}, len(a) AS n_words, unnest(a) AS word FROM eligible",
            "task_words": "SELECT occ_idx, unnest(b) AS word FROM cand_words",
            "shared_words": f"""SELECT t.{key}, t.occ_idx, count(*) AS shared
                                FROM top t JOIN text_words w USING ({key}) JOIN task_words c USING (occ_idx, word)
                                GROUP BY t.{key}, t.occ_idx""",
            "rr": f"""SELECT t.{key}, t.rank, t.occ_idx, t.score, round(coalesce(s.shared, 0) /
                        (len(e.a) + len(c.b) - coalesce(s.shared, 0)), 6) AS rr
                      FROM top t JOIN eligible e USING ({key}) JOIN cand_words c USING (occ_idx)
                        LEFT JOIN shared_words s ON s.{key} = t.{key} AND s.occ_idx = t.occ_idx""",
            "rr_best": f"""SELECT * FROM (SELECT *, row_number() OVER (
                             PARTITION BY {key} ORDER BY rr DESC, rank) AS n FROM rr) WHERE n = 1""",
        }
    else:
        threshold = 0.0
        ctes["rr_best"] = f"""SELECT {key}, rank, occ_idx, score, CAST(NULL AS DOUBLE) AS rr
                              FROM top WHERE false"""
    ctes |= {
        "chosen": f"""
          SELECT t.{key}, t.score AS best, coalesce(r.occ_idx, t.occ_idx) AS occ_idx,
                 coalesce(r.score, t.score) AS score, coalesce(r.rank, 1) AS rank, r.rr
          FROM (SELECT * FROM top WHERE rank = 1) t LEFT JOIN rr_best r USING ({key})""",
        "judged": f"""
          SELECT j.*, c.best, c.score, c.rank, c.rr, o.* EXCLUDE (v),
            c.best IS NOT NULL AND c.best >= {min_score} AS near,
            c.rr IS NULL OR c.rr >= {threshold} AS accepted,
            k.keywords IS NULL OR c.score >= 0.75 OR len(list_filter(k.keywords,
              lambda w: contains(j.standardized_job_description, w))) > 0 AS plausible
          FROM jobs j LEFT JOIN chosen c USING ({key}) LEFT JOIN occ o USING (occ_idx)
            LEFT JOIN rules k ON k.occupation = o.Level4_Name""",
        "flagged": "SELECT *, near AND accepted AND plausible AS ok FROM judged",
    }
    attributes = ",\n".join(
        f"CASE WHEN ok THEN {source} ELSE {quoted(default)} END AS {target}"
        for target, source, default in [
            ("match_occupation", "Level4_Name", "未匹配"),
            ("match_main_task", "main_task", "未匹配"),
            *[(f"match_{name}", name, "") for name in fixed.MATCH_LEVEL_COLUMNS],
        ]
    )
    ctes["matched"] = f"""
      SELECT {carried}, {attributes},
        CASE WHEN near AND accepted THEN score ELSE coalesce(best, 0.0) END AS embed_score,
        CASE WHEN near AND rr IS NOT NULL THEN rr ELSE 0.0 END AS rerank_score,
        CAST(CASE WHEN ok THEN rank ELSE 1 END AS INTEGER) AS match_rank,
        CASE WHEN ok THEN '是' ELSE '否' END AS is_match
      FROM flagged"""
    return ctes


JOB_COLUMNS = "doc_id, year, standardized_job_description"


def match_ctes(**options) -> dict[str, str]:
    return {
        "jobs": JOBS,
        "occ": OCCUPATIONS,
        **search_ctes(),
        **decision_ctes(JOB_COLUMNS, **options),
    }


# --- crosswalk ----------------------------------------------------------------

_TYPES = "[" + ", ".join(quoted(kind) for kind in views.PART_TYPES) + "]"


def onet_code(number: str, family: str) -> str:
    return (
        f"CAST(11 + ({family}) * 2 AS VARCHAR) || '-' || "
        f"lpad(CAST(({number}) * 37 AS VARCHAR), 4, '0') || '.00'"
    )


MAPPING = f"""
  SELECT concat_ws('-', label % 8 + 1, {_TWO('bucket % 4 + 1')}, {_TWO('label + 1')},
                   {_TWO('bucket + 1')}) AS dadian_code,
         {onet_code('n', 't')} AS onet_code, name || ' ' || n AS onet_title,
         round(price / 2000, 6) AS similarity_score,
         CASE WHEN price > 1000 THEN 'high' ELSE 'low' END AS confidence
  FROM (SELECT *, (n * 6 + t) % 144 // 16 AS label, (n * 6 + t) % 144 % 16 AS bucket FROM (
    SELECT CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS n,
           list_position({_TYPES}, p_type) - 1 AS t,
           max(p_retailprice) AS price, min(p_name) AS name
    FROM part GROUP BY 1, 2))"""

DETAIL = f"""
  SELECT {onet_code('n_nationkey + 1', 'n_regionkey')} AS soc, n_name AS Description,
         'tasks ' || suppliers AS All_Tasks
  FROM nation JOIN (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1)
    ON s_nationkey = n_nationkey"""

BEST_MAPPING = """
  SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (
    PARTITION BY dadian_code ORDER BY similarity_score DESC, onet_code) AS n FROM mapping)
  WHERE n = 1"""


def crosswalk_ctes(mapping: str = "mapping", details: bool = True) -> dict[str, str]:
    """CTEs ending in ``final``, over ``matched``."""
    more = ", d.Description AS onet_description, d.All_Tasks AS onet_tasks" if details else ""
    join = "LEFT JOIN detail d ON d.soc = m.onet_code" if details else ""
    return {
        "mapping": MAPPING,
        "best_mapping": BEST_MAPPING,
        "detail": DETAIL,
        "final": f"""
          SELECT j.*, coalesce(nullif(match_Level1_Name, ''), '未匹配') AS level1,
                 coalesce(nullif(match_Level1_Code, ''), '00') AS level1_code,
                 m.onet_code, m.onet_title, m.similarity_score AS onet_similarity_score,
                 m.confidence AS onet_confidence{more}
          FROM matched j LEFT JOIN {mapping} m ON j.match_Level4_Code = m.dadian_code {join}""",
    }


def final_ctes(min_score: float, **options) -> dict[str, str]:
    return {**match_ctes(min_score=min_score), **crosswalk_ctes(**options)}


# --- stand-in embedding -------------------------------------------------------


def letter_profile(text: str) -> str:
    """Letter counts a-z as a unit vector in single precision."""
    folded = f"lower({text})"
    return (
        "[" + ", ".join(
            f"CAST(length({folded}) - length(replace({folded}, '{chr(c)}', '')) AS DOUBLE)"
            for c in range(97, 123)
        ) + "]"
    )


def unit_floats(profile: str, length: str) -> str:
    return (
        f"CAST(CAST(list_transform({profile}, lambda x: CASE WHEN {length} = 0 THEN 0.0 "
        f"ELSE x / {length} END) AS FLOAT[]) AS DOUBLE[])"
    )


def profile_ctes(name: str, source: str, text: str) -> dict[str, str]:
    """CTEs ending in ``name``: the rows of ``source`` with their unit vector ``v``."""
    return {
        f"{name}_counted": f"SELECT *, {letter_profile(text)} AS profile FROM {source}",
        f"{name}_measured": f"SELECT *, {norm('profile')} AS length FROM {name}_counted",
        name: f"""SELECT * EXCLUDE (profile, length), {unit_floats('profile', 'length')} AS v
                  FROM {name}_measured""",
    }


PART_OCCUPATIONS = f"""
  SELECT occ_idx, p_name AS Level4_Name, p_type || ' ' || brand AS main_task,
         CAST(t + 1 AS VARCHAR) AS Level1_Code, p_type AS Level1_Name,
         concat_ws('-', t + 1, {_TWO('occ_idx % 90 + 1')}) AS Level2_Code,
         'group ' || concat_ws('-', t + 1, occ_idx % 90 + 1) AS Level2_Name,
         concat_ws('-', t + 1, {_TWO('occ_idx % 90 + 1')}) AS Level3_Code,
         'family ' || concat_ws('-', t + 1, occ_idx % 90 + 1) AS Level3_Name,
         concat_ws('-', t % 6 + 1, {_TWO('occ_idx % 4 + 1')}, {_TWO('t + 1')},
                   {_TWO('occ_idx % 16 + 1')}) AS Level4_Code
  FROM (SELECT p_type, p_name, list_position({_TYPES}, p_type) - 1 AS t,
               min(p_partkey) AS occ_idx, max(p_brand) AS brand
        FROM part GROUP BY 1, 2, 3)"""

# The whole prompt in front of a posting, written out so that a changed one is noticed.
GOLDEN_PROMPT = """\
你是"职业描述标准化"助手。请把输入的招聘职位描述改写成标准化职业描述，风格参考《职业分类大典2022》的 main_task：简洁、客观、任务导向。
请把下面的职位描述标准化改写，要求：
1) 仅保留"岗位职责/工作内容"，删除任职要求、福利、公司介绍、口号等；
2) 不新增不存在的信息，不推断；保持原意与关键职责；
3) 用中文输出，使用"1. …；2. …；3. …"格式，写出2-5条任务；
4) 输出仅包含标准化职业描述文本，不要加解释、标题或其他内容；
5) 只要存在明确的任务或职责描述，就必须抽取并输出；
6) 如果输入为空或完全无法识别岗位职责，输出"无法识别"。

以下是《职业分类大典2022》main_task 的标准表达示例（仅用于风格参考）：
示例1：1.策划网站内容;2.组织网站稿件;3.运用信息发布系统或相关软件,制作网页;4.编辑网页内容;5.进行网站内容的检查、管理。
示例2：1.使用功能测试用例等工具,测试计算机软件功能;2.使用性能测试用例等工具,进行计算机软件负载测试和压力测试;3.使用计算机及附属设备,测试计算机软件的稳定性、兼容性等参数;4.记录测试数据和案例;5.编写、制作测试报告。
示例3：1.根据实际发生的经济业务或者事项进行会计核算;2.对单位的经济活动或者事项进行会计监督;3.制订单位的内部会计管理制度;4.分析、运用财务、业务等信息,服务单位规划、决策、控制、评价等工作。

职位描述：
"""

PROMPT_PREFIX = quoted(GOLDEN_PROMPT)
