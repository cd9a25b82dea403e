# -*- coding: utf-8 -*-
"""Lists, labels, thresholds, patterns and prompt wording.

Results depend on these exact values, so they are stated once, as plain text.
Every one of them is only a default; the operators take them as parameters.
"""

# --- Fixed values: text rules -------------------------------------------------

UNRECOGNIZED = "无法识别"

# Opening phrases of a duty section, in the order in which they are applied.
DUTY_HEADERS = [
    "岗位职责",
    "工作职责",
    "岗位内容",
    "工作内容",
    "职位描述",
    "岗位描述",
    "主要职责",
    "主要工作",
    "职责描述",
    "工作任务",
    "任务描述",
    "职责范围",
    "岗位任务",
]

# Opening phrases of a section that ends the duties, in order of application.
NEGATIVE_HEADERS = [
    "任职要求",
    "岗位要求",
    "任职资格",
    "任职条件",
    "职位要求",
    "岗位条件",
    "资格要求",
    "加分项",
    "福利待遇",
    "薪资待遇",
    "薪资福利",
    "公司介绍",
    "企业介绍",
    "关于我们",
    "我们提供",
    "你将获得",
    "你需要",
    "我们希望",
]

# Delimiters after an item number and the marks that may end an item.
NUMBER_DELIMITERS = r"[\.、\)）]"
SENTENCE_ENDS = "；;。.！!？?"
ITEM_END = "；"
HEADER_COLON = "："

MIN_EFFECTIVE_LEN = 30
MIN_INPUT_LEN = 10
MAX_INPUT_CHARS = 1024
YEAR_PATTERN = r"(19|20)\p{Nd}{2}"
UNKNOWN_YEAR = "unknown"

# --- Fixed values: matching ---------------------------------------------------

TOP_K = 10
MIN_EMBED_SCORE = 0.55
RERANK_SCORE_THRESHOLD = 0.2
RERANK_MIN_EMBED_SCORE = 0.4
RULE_BYPASS_SCORE = 0.75

UNMATCHED_LABEL = "未匹配"
IS_MATCH_YES = "是"
IS_MATCH_NO = "否"

# A match to one of these occupations needs one of its keywords in the text.
SUSPICIOUS_OCCUPATIONS = {
    "法官": ["法律", "案件", "审判", "法院", "诉讼", "判决", "庭审"],
    "检察官": ["法律", "案件", "检察", "起诉", "公诉", "法律监督"],
    "律师": ["法律", "案件", "辩护", "法律顾问", "诉讼", "代理"],
    "宗教教职人员": ["宗教", "教会", "寺庙", "信仰", "教义", "礼拜"],
    "僧人": ["佛教", "寺院", "修行", "佛法", "禅修"],
    "道士": ["道教", "道观", "法事", "道法", "修炼"],
    "牧师": ["教会", "牧养", "礼拜", "基督教", "神学"],
}

# --- Fixed values: crosswalk --------------------------------------------------

NO_LEVEL1_CODE = "00"
JOIN_FAILURE_ALARM = 0.05

# --- Fixed values: column names and file names --------------------------------

ID_COLUMN = "rec_id"
TEXT_COLUMN = "position_responsibilities"
STANDARDIZED_COLUMN = "standardized_job_description"
RAW_FILE_TEMPLATE = "recruitment_infos_content_{year}.csv"
FINAL_FILE_TEMPLATE = "{year}_final.parquet"

LEVEL_CODE_COLUMNS = ["Level1_Code", "Level2_Code", "Level3_Code", "Level4_Code"]
OCCUPATION_NAME_COLUMN = "Level4_Name"
OCCUPATION_TASK_COLUMN = "main_task"
MATCH_LEVEL_COLUMNS = [
    "Level1_Code",
    "Level1_Name",
    "Level2_Code",
    "Level2_Name",
    "Level3_Code",
    "Level3_Name",
    "Level4_Code",
    "Level4_Name",
]

# --- Fixed values: prompt wording ---------------------------------------------

SYSTEM_PROMPT = (
    '你是"职业描述标准化"助手。请把输入的招聘职位描述改写成标准化职业描述，'
    '风格参考《职业分类大典2022》的 main_task：简洁、客观、任务导向。'
)

USER_PROMPT = """请把下面的职位描述标准化改写，要求：
1) 仅保留"岗位职责/工作内容"，删除任职要求、福利、公司介绍、口号等；
2) 不新增不存在的信息，不推断；保持原意与关键职责；
3) 用中文输出，使用"1. …；2. …；3. …"格式，写出2-5条任务；
4) 输出仅包含标准化职业描述文本，不要加解释、标题或其他内容；
5) 只要存在明确的任务或职责描述，就必须抽取并输出；
6) 如果输入为空或完全无法识别岗位职责，输出"无法识别"。

以下是《职业分类大典2022》main_task 的标准表达示例（仅用于风格参考）：
{example_tasks}

职位描述：
"""

EXAMPLE_LINE = "示例{number}：{task}"
NO_EXAMPLES = "（无）"

EXAMPLE_TASKS = [
    "1.策划网站内容;2.组织网站稿件;3.运用信息发布系统或相关软件,制作网页;4.编辑网页内容;5.进行网站内容的检查、管理。",
    "1.使用功能测试用例等工具,测试计算机软件功能;2.使用性能测试用例等工具,进行计算机软件负载测试和压力测试;3.使用计算机及附属设备,测试计算机软件的稳定性、兼容性等参数;4.记录测试数据和案例;5.编写、制作测试报告。",
    "1.根据实际发生的经济业务或者事项进行会计核算;2.对单位的经济活动或者事项进行会计监督;3.制订单位的内部会计管理制度;4.分析、运用财务、业务等信息,服务单位规划、决策、控制、评价等工作。",
]
