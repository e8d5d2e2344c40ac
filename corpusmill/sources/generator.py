"""Seeded review generator for fixtures: sentences from templates and word slots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.lexicons import REVIEW_CLASSES
from corpusmill.functions.text import any_hit

# A fixed set of templates and words in the manner of shop reviews: ten for each class, eleven slots.
TEMPLATES = {
    "positive": (
        "{item}很好，{part}令人满意，推荐购买。",
        "{brand}的{item}不错，{part}超出预期。",
        "送给{person}的{item}，{reply}，{extra}。",
        "第{count}回下单了，{item}{state}，下次还来。",
        "{part}比想象中好，而且{extra}。",
        "昨天下单今天就到，{item}的{part}没得挑。",
        "用到现在{state}，{part}也一直稳定。",
        "这个价位能有这样的{part}，很划算，{extra}。",
        "店家回复及时，{item}{state}，给好评。",
        "{person}也想要一台{brand}{item}，{part}确实出色。",
    ),
    "negative": (
        "{item}很差，{part}有问题，不建议购买。",
        "{brand}的{item}让人失望，{part}卡顿。",
        "刚到手就{fault}，{item}打算退掉。",
        "发货{degree}，收到以后还{fault}。",
        "{part}{degree}，问了客服也没有结果。",
        "宣传的{part}和实物对不上，{fault}。",
        "第{count}次维修了，还是{fault}，不会再买。",
        "花了大价钱，{part}却{degree}，后悔。",
        "{person}用了两天就说{fault}，{item}白买了。",
        "{brand}售后{degree}，{fault}也没人处理。",
    ),
    "neutral": (
        "{item}一般，{part}还可以。",
        "{brand}的{item}收到了，{part}待观察。",
        "先用着看，{part}{view}。",
        "价格{degree}，不过{item}{view}。",
        "{item}和之前那台差不多，{view}。",
        "替{person}买的，{part}怎么样还不清楚。",
        "包装普通，{item}{state}，{view}。",
        "谈不上喜欢，{part}{view}。",
        "第{count}天的感受：{part}中等，{view}。",
        "{brand}{item}就是这个水平，{view}。",
    ),
}
SLOTS = {
    "item": ("手机", "耳机", "充电器", "平板", "手表", "键盘", "音箱", "路由器", "台灯", "相机"),
    "brand": ("华为", "小米", "苹果", "三星", "荣耀", "联想", "索尼"),
    "part": ("外观", "性能", "续航", "拍照", "音质", "屏幕", "做工", "按键", "重量", "配件"),
    "person": ("父母", "孩子", "同学", "同事", "邻居"),
    "reply": ("对方很开心", "都说合适", "当场就用上了", "一直夸好"),
    "extra": ("还送了小礼品", "价格也合理", "安装很方便", "包装仔细", "说明清楚", "颜色也好看"),
    "count": ("二", "三", "四", "五"),
    "state": ("没出过毛病", "做得结实", "很耐用", "手感扎实", "表现不错"),
    "fault": ("自动关机", "掉漆", "发烫", "连不上网", "充不进电", "有异响"),
    "degree": ("太慢", "偏差", "不行", "一般", "偏高", "不稳定"),
    "view": ("日常够用", "没有惊喜", "还能接受", "说不上好坏", "对得起价格"),
}


def _pick(options: Sequence[str], key: Column, salt: str) -> Column:
    at = F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(len(options))).cast("int") + 1
    return F.element_at(F.array(*map(F.lit, options)), at)


def reviews(
    spark: SparkSession,
    n: int,
    seed: int = 42,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    slots: Mapping[str, Sequence[str]] = SLOTS,
) -> DataFrame:
    """n reviews id, text, timestamp; a class first, then one of its templates, then its words."""
    key = F.concat_ws("/", F.lit(str(seed)), F.col("id").cast("string"))
    kinds = list(templates)
    kind = _pick(kinds, key, "kind")
    text = F.when(kind == kinds[0], _pick(templates[kinds[0]], key, "template"))
    for k in kinds[1:]:
        text = text.when(kind == k, _pick(templates[k], key, "template"))
    for slot, words in slots.items():
        text = F.replace(text, F.lit("{" + slot + "}"), _pick(words, key, slot))
    seconds = F.pmod(F.xxhash64(key, F.lit("time")), F.lit(30 * 86400))
    stamp = F.date_format(F.timestamp_seconds(F.lit(1772323200) + seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return spark.range(1, n + 1).select(F.format_string("r-%06d", "id").alias("id"), text.alias("text"), stamp.alias("timestamp"))


def class_counts(texts: DataFrame, classes: Sequence[tuple[str, Sequence[str]]] = REVIEW_CLASSES, other: str = "neutral") -> DataFrame:
    """(kind, n): reviews by the first class of which a word stands in the text; all classes are listed."""
    kind = F.lit(other)
    for name, words in reversed(classes):
        kind = F.when(any_hit(F.coalesce("text", F.lit("")), words), name).otherwise(kind)
    names = texts.sparkSession.createDataFrame([(name,) for name in (*(n for n, _ in classes), other)], "kind string")
    found = texts.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return names.join(found, "kind", "left").select("kind", F.coalesce("n", F.lit(0)).alias("n"))
