"""Domain scores from a table of concepts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Concept:
    name: str
    english: str
    chinese: tuple[str, ...]
    strong: bool = False


def _parse(table: str, strong: bool) -> tuple[Concept, ...]:
    out = []
    for row in table.strip().splitlines():
        name, english, *chinese = (part.strip() for part in row.split("|"))
        words = "|".join(rf"\b{w.strip().replace(' ', chr(92) + 's+')}\b" for w in english.split(";"))
        out.append(Concept(name, words, tuple(c for c in chinese if c), strong))
    return tuple(out)


# The concepts of each domain, as name | English patterns parted by ; | Chinese terms.
EDUCATION = _parse(
    r"""
education | education | 教育
educational | educational |
school | schools? | 学校
student | students? | 学生
teacher | teachers? | 教师
teaching | teaching | 教学
university | university;universities | 大学
college | colleges? | 学院
curriculum | curriculum;curricula | 课程
classroom | classrooms? | 课堂
literacy | literacy | 扫盲
higher_education | higher education | 高等教育
primary_education | primary education | 基础教育 | 初等教育
secondary_education | secondary education | 中等教育
vocational_education | vocational education | 职业教育
preschool | pre-?school | 学前教育
enrollment | enrollment;enrolment | 入学 | 招生
scholarship | scholarships? | 奖学金
academic_institution | academic institutions? | 教育机构
""",
    strong=True,
)
TECHNOLOGY_STRONG = _parse(
    r"""
artificial_intelligence | artificial intelligence | 人工智能
machine_learning | machine learning | 机器学习
deep_learning | deep learning | 深度学习
computer | computers? | 计算机
software | software | 软件
hardware | hardware | 硬件
algorithm | algorithms? | 算法
database | databases? | 数据库
internet | internet | 互联网
cybersecurity | cybersecurity | 网络安全
semiconductor | semiconductors? | 半导体
microchip | microchips? | 芯片
robotics | robotics? | 机器人
automation | automation | 自动化
biotechnology | biotechnology | 生物技术
telecommunications | telecommunications? | 电信
information_technology | information technology | 信息技术
digital_technology | digital technology | 数字技术
aerospace | aerospace | 航天
""",
    strong=True,
)
TECHNOLOGY_GENERAL = _parse(
    r"""
technology | technology;technologies;technical | 科技 | 技术
science | sciences?;scientific | 科学
data | data | 数据
network | networks? | 网络
communication | communications? | 通信
electronic | electronics? | 电子
engineering | engineering | 工程
energy | energy | 能源
satellite | satellites? | 卫星
research | research | 科研 | 研究
innovation | innovations? | 创新
""",
    strong=False,
)
FINANCE_STRONG = _parse(
    r"""
fiscal | fiscal | 财政
budget | budgets? | 预算
tax | tax;taxes;taxation | 税收 | 税务
debt | debts? | 债务
investment | investments?;investors? | 投资 | 投资者
banking | banking;central banks? | 银行业 | 中央银行
currency | currency;currencies;monetary | 货币 | 汇率
securities | security;securities | 证券
bond | bonds? | 债券
stock | stock markets?;stocks?;shares? | 股票 | 股市
credit_loan | credit;loans?;lending | 信贷 | 贷款 | 融资
insurance | insurance | 保险
interest_rate | interest rates? | 利率
inflation_gdp | inflation;GDP;gross domestic product | 通货膨胀 | 国内生产总值
revenue_expenditure | revenues?;expenditures? | 财政收入 | 财政支出
""",
    strong=True,
)
FINANCE_GENERAL = _parse(
    r"""
finance | finance;financial | 金融
economy | economic;economy;economies | 经济
trade | trade | 贸易
bank | banks? | 银行
market | markets? | 市场
capital_fund | capital;funds? | 资本 | 基金 | 资金
payment_income | payments?;incomes?;profits? | 支付 | 收入 | 利润
prices | prices? | 价格 | 物价
accounting_audit | accounting;audits? | 会计 | 审计
international_trade | imports?;exports?;tariffs?;commerce | 进口 | 出口 | 关税 | 商业
""",
    strong=False,
)
# Contexts in which a general concept of finance means something else: (name, concept, phrases, Chinese phrases).
FINANCE_EXCLUSIONS = (
    ("trade_union_only", "trade", r"\btrade\b", r"\btrade\s+unions?\b", ("工会",)),
    ("economic_rights_only", "economy", r"\beconomic\b|\beconom(?:y|ies)\b", r"\beconomic\s*,?\s*social\s+and\s+cultural\s+rights\b", ("经济、社会和文化权利", "经济社会文化权利")),
    ("financial_aid_or_compensation_only", "finance", r"\bfinance\b|\bfinancial\b", r"\bfinancial\s+(?:aid|assistance|support|compensation|reparations?)\b", ("金融援助", "财政援助", "财政赔偿", "金融赔偿")),
    ("geographical_bank_only", "bank", r"\bbanks?\b", r"\briver\s+banks?\b|\bbanks?\s+of\s+(?:the\s+)?(?:river|lake|canal)\b", ("河岸", "江岸", "湖岸")),
)
DOMAINS = {
    "education": EDUCATION,
    "technology": TECHNOLOGY_STRONG + TECHNOLOGY_GENERAL,
    "finance": FINANCE_STRONG + FINANCE_GENERAL,
}


def matched(zh: Column, en: Column, concepts: Sequence[Concept]) -> Column:
    """Names of the concepts that either side shows, in table order."""
    hits = []
    for c in concepts:
        test = en.rlike("(?i)" + c.english)
        for term in c.chinese:
            test = test | zh.contains(term)
        hits.append(F.when(test, F.lit(c.name)))
    return F.array_compact(F.array(*hits))


def finance_exclusions(zh: Column, en: Column, general: Column) -> Column:
    """Names of the exclusions that hold, sorted.

    A general concept is excluded when every English mention lies in the
    excluded phrase and the Chinese either lacks its term or has the excluded
    phrase too. The bank needs an English mention, and trade and bank do not
    outlive their Chinese term.
    """
    count = lambda p: F.regexp_count(en, F.lit("(?i)" + p))
    found = []
    for name, concept, word, phrase, terms in FINANCE_EXCLUSIONS:
        term = next(c.chinese[0] for c in FINANCE_GENERAL if c.name == concept)
        test = F.array_contains(general, concept) & (count(word) <= count(phrase))
        chinese = ~zh.contains(term)
        if name in ("economic_rights_only", "financial_aid_or_compensation_only"):
            chinese = chinese | zh.rlike("|".join(terms))
        if concept == "bank":
            test = test & (count(word) > 0)
        found.append(F.when(test & chinese, F.lit(name)))
    return F.array_sort(F.array_compact(F.array(*found)))


def domain_score(zh: Column | str, en: Column | str, domain: str) -> Column:
    """Struct (strong, general, excluded, score, eligible) of a pair for one domain.

    A strong concept scores 3, a general one 1. One strong or two general
    concepts make a pair eligible; excluded general concepts do not count.
    """
    zh, en = (F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit("")) for x in (zh, en))
    concepts = DOMAINS[domain]
    strong = matched(zh, en, [c for c in concepts if c.strong])
    weak = [c for c in concepts if not c.strong]
    general = matched(zh, en, weak) if weak else F.array().cast("array<string>")
    excluded = finance_exclusions(zh, en, general) if domain == "finance" else F.array().cast("array<string>")
    if domain == "finance":
        dropped = F.transform(excluded, lambda x: F.create_map(*[v for e in FINANCE_EXCLUSIONS for v in (F.lit(e[0]), F.lit(e[1]))])[x])
        general = F.array_except(general, dropped)
    return F.struct(
        strong.alias("strong"), general.alias("general"), excluded.alias("excluded"),
        (3 * F.size(strong) + F.size(general)).alias("score"), ((F.size(strong) > 0) | (F.size(general) >= 2)).alias("eligible"),
    )


def review_reasons(score: Column, domain: str) -> Column:
    """Why a pair is not taken for a domain."""
    strong, general = F.size(score["strong"]), F.size(score["general"])
    none = F.when((strong == 0) & (general == 0), F.lit(f"no_explicit_{domain}_concept" if domain == "education" else f"no_{domain}_concept"))
    one = F.when((strong == 0) & (general == 1), F.lit(f"only_one_general_{domain}_concept"))
    below = F.when(~score["eligible"], F.lit(f"{domain}_threshold_not_met"))
    return F.when(score["eligible"], F.array().cast("array<string>")).otherwise(F.concat(F.array_compact(F.array(none, one, below)), F.transform(score["excluded"], lambda x: F.concat(F.lit("excluded_"), x))))


def best_label(labels: Sequence[str], scores: Sequence[Column]) -> Column:
    """The label with the largest score; the first of equals, also where all are 0."""
    ranked = [F.struct(s.cast("int").alias("s"), F.lit(-i).alias("p"), F.lit(l).alias("l")) for i, (l, s) in enumerate(zip(labels, scores))]
    return F.array_max(F.array(*ranked))["l"]
