"""Word lists of the rule-based labelling and evaluation of Chinese reviews."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lexicon:
    positive: tuple[str, ...]
    negative: tuple[str, ...]
    positive_reason: tuple[str, ...]
    negative_reason: tuple[str, ...]
    contrast: tuple[str, ...]
    entities: tuple[str, ...]
    entity_patterns: tuple[str, ...]
    entity_regex: str


REVIEWS = Lexicon(
    positive=("不错", "满意", "很好", "好用", "优秀", "推荐", "超出预期", "名不虚传", "喜欢", "棒", "值得", "对得起", "稳定", "扎实", "精美", "精细", "惊喜", "靠谱", "丝滑"),
    negative=("很差", "失望", "不好", "问题", "卡顿", "不耐用", "发热严重", "死机", "不建议", "不符", "一般般", "不太", "很慢", "噪音", "掉电", "发烫", "划痕", "瑕疵", "漏光", "断连"),
    positive_reason=("满意", "推荐", "稳定", "对得起", "优秀", "值得", "喜欢", "好"),
    negative_reason=("失望", "问题", "慢", "不好", "不符", "不建议", "差", "瑕疵"),
    contrast=("但是", "不过", "但", "然而"),
    entities=("华为", "小米", "苹果", "OPPO", "vivo", "三星", "荣耀", "手机", "耳机", "充电器", "保护壳", "平板", "手表", "键盘", "鼠标", "显示器", "音响", "外观", "性能", "续航", "拍照", "音质", "屏幕", "手感", "做工", "包装", "配件", "客服", "物流", "售后"),
    entity_patterns=("售后服务", "客服", "物流", "价格", "拍照", "续航", "信号", "电池", "保护壳", "性能", "外观", "手感", "屏幕", "音质", "配件", "体验", "做工", "包装"),
    entity_regex="[一-鿿]{2,6}",
)

#: Hints of the evaluation, shorter than those of the labelling.
EVAL_POSITIVE_REASON = ("满意", "推荐", "稳定", "值得", "好", "优秀")
EVAL_NEGATIVE_REASON = ("失望", "问题", "慢", "差", "不建议", "不符", "瑕疵")
EVAL_KEY_ENTITIES = ("价格", "拍照", "售后服务", "客服", "物流", "性能", "外观", "续航", "信号")
EMPTY_ENTITIES = ("", "[]", "[ ]", "null", "None")

#: Classes of the review generator's statistics, first match first.
REVIEW_CLASSES = (
    ("positive", ("不错", "满意", "好", "棒", "优秀", "推荐")),
    ("negative", ("差", "失望", "不好", "问题", "卡顿")),
)
