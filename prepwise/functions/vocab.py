"""Fixed values.

FIXED VALUES — these lists must equal the behaviour being matched for the
results to agree (missing-value tokens, boolean words, date and ID words,
unit dictionary, smart punctuation, full-width symbols).  They are stated
plainly, in their natural order, and are not derived from anything else.
"""
from __future__ import annotations

# ---- FIXED VALUES: missing-value tokens (compared after trimming, case-sensitive)
NA_TOKENS = [
    "N/A", "n/a", "NA", "na", "null", "NULL", "Null",
    "None", "none", "NONE", " ", "", ".", "-", "--",
    "未知", "无", "缺失", "空缺", "不详",
    "#N/A", "#VALUE!", "#REF!", "#DIV/0!", "#NUM!", "#NAME?",
]

# ---- FIXED VALUES: boolean vocabularies (a column's lowered, trimmed values
# must all fall inside one pair)
BOOL_PAIRS = [
    ("true", "false"),
    ("yes", "no"),
    ("y", "n"),
    ("是", "否"),
    ("真", "假"),
    ("1", "0"),
    ("t", "f"),
]
TRUE_WORDS = ["true", "yes", "y", "是", "真", "1", "t"]
FALSE_WORDS = ["false", "no", "n", "否", "假", "0", "f"]

# ---- FIXED VALUES: words that mark a column name as a date (substring match)
DATE_NAME_WORDS = [
    "日期", "时间", "date", "time", "datetime", "timestamp",
    "创建", "修改", "更新", "注册", "生日", "出生", "入职", "离职",
    "开始", "结束", "截止", "有效期", "created", "updated", "modified",
    "birth", "start", "end", "deadline",
]

# ---- FIXED VALUES: words that mark a column name as an ID (case-folded substring)
ID_NAME_WORDS = [
    "id", "编号", "序号", "代码", "code", "uuid", "guid", "key", "serial", "no", "号",
]

# ---- FIXED VALUES: unit dictionary, category → units
UNIT_CATEGORIES = {
    "重量": ["kg", "g", "mg", "t", "公斤", "千克", "斤", "两", "吨", "μg", "ng"],
    "长度": ["km", "m", "cm", "mm", "μm", "nm", "千米", "米", "厘米", "毫米", "微米", "纳米", "里", "公里"],
    "面积": ["km²", "m²", "cm²", "mm²", "公顷", "亩", "平方米", "平方千米", "平方公里"],
    "体积": ["L", "mL", "μL", "m³", "cm³", "升", "毫升", "立方米", "立方厘米", "加仑"],
    "时间": ["h", "min", "s", "ms", "小时", "分钟", "秒", "毫秒", "天", "周", "月", "年", "日"],
    "温度": ["°C", "°F", "K", "摄氏度", "华氏度"],
    "货币": ["元", "万元", "亿元", "美元", "欧元", "日元", "英镑", "港币", "澳元", "$", "€", "¥", "£", "￥"],
    "速度": ["km/h", "m/s", "kmh", "mph", "千米/小时", "米/秒", "节"],
    "百分比": ["%", "‰", "％"],
    "计数": ["个", "只", "条", "件", "台", "辆", "次", "人", "户", "家", "笔", "张", "本", "册",
           "套", "颗", "粒", "片", "支", "瓶", "盒", "包", "袋", "箱", "份"],
    "电力": ["V", "kV", "A", "mA", "W", "kW", "MW", "kWh", "MWh", "Ω", "伏", "安", "瓦", "千瓦",
           "度", "伏特", "安培"],
    "压强": ["Pa", "kPa", "MPa", "bar", "atm", "mmHg", "帕", "千帕", "兆帕", "巴"],
    "频率": ["Hz", "kHz", "MHz", "GHz", "赫兹", "千赫", "兆赫"],
    "数据": ["B", "KB", "MB", "GB", "TB", "PB", "bps", "Mbps", "Gbps", "字节"],
    "浓度": ["mol/L", "mmol/L", "μmol/L", "g/L", "mg/L", "μg/L", "mg/mL", "ppm", "ppb"],
    "能量": ["J", "kJ", "MJ", "cal", "kcal", "焦耳", "千焦", "卡", "千卡", "大卡"],
    "角度": ["°", "rad", "度", "弧度"],
}
# The percent category is left out by default so that "50%" reaches the
# percent step and becomes 0.5 (otherwise the unit step would turn it into 50).
DEFAULT_UNIT_EXCLUDE = ("百分比",)

# ---- FIXED VALUES: smart punctuation → ASCII
SMART_PUNCT_1TO1 = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", " ": " "}
SMART_PUNCT_MULTI = {"—": "--", "…": "..."}

# ---- FIXED VALUES: full-width symbols → half width (letters, digits and
# U+3000 follow the rule in fullwidth_pairs below)
FULLWIDTH_SYMBOLS = {
    "，": ",", "．": ".", "：": ":", "；": ";",
    "！": "!", "？": "?", "（": "(", "）": ")",
    "［": "[", "］": "]", "｛": "{", "｝": "}",
    "＋": "+", "－": "-", "＝": "=", "＊": "*",
    "／": "/", "＼": "\\", "＄": "$", "％": "%",
    "＃": "#", "＠": "@", "＆": "&", "＾": "^",
    "～": "~", "＿": "_", "｜": "|",
}

# ---- FIXED VALUES: characters turned into "_" in column names
NAME_SPECIAL_CHARS = r"\s\-\.\(\)\[\]\{\}（）、，。；：！？《》【】／＼＂＇｜＋＝＊＆＾％＄＃＠！～、"


def fullwidth_pairs() -> tuple[str, str]:
    """(source, target) strings for ``translate``: Ａ-Ｚ, ａ-ｚ, ０-９ shift by
    0xFEE0, U+3000 becomes a space, plus the fixed symbol table."""
    src, dst = [], []
    for lo, hi in ((0xFF10, 0xFF19), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A)):
        for cp in range(lo, hi + 1):
            src.append(chr(cp))
            dst.append(chr(cp - 0xFEE0))
    src.append("　")
    dst.append(" ")
    for k, v in FULLWIDTH_SYMBOLS.items():
        src.append(k)
        dst.append(v)
    return "".join(src), "".join(dst)


def units_for(categories=None, exclude=DEFAULT_UNIT_EXCLUDE) -> list[str]:
    """Units of the chosen categories, longest first (so 万元 wins over 元)."""
    cats = list(categories) if categories else [c for c in UNIT_CATEGORIES if c not in exclude]
    seen: list[str] = []
    for cat in cats:
        for u in UNIT_CATEGORIES.get(cat, []):
            if u not in seen:
                seen.append(u)
    # NFKC rewrites m² → m2, ℃ → °C ...; keep the normalised spelling too.
    import unicodedata
    for u in list(seen):
        n = unicodedata.normalize("NFKC", u)
        if n not in seen:
            seen.append(n)
    return sorted(seen, key=len, reverse=True)
