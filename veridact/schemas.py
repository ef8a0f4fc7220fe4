"""Vocabularies, thresholds and row schemas of the review engine (fixed values)."""

from __future__ import annotations

from dataclasses import dataclass

ASPECTS = (
    "보습감", "흡수력", "발림감/텍스처", "지속성", "향", "광택/윤기", "커버력", "발색",
    "유분/번들거림", "트러블/자극", "탄력/탱탱함", "분사력", "밀착력", "가성비",
)
POLARITIES = ("positive", "negative", "neutral")
UNSTATED = "미기재"
CELL_AXES = ("product", "skinType", "skinTrouble")
GATE_ORDER = {"identity": 1, "duplicate": 2, "polarity": 3, "sufficiency": 4}
REJECT_REASONS = {
    "identity": ("product_mismatch", "option_mismatch", "option_unstated", "renewal_cut", "recency_cut"),
    "duplicate": ("duplicate_content", "same_author", "duplicate_semantic"),
    "polarity": (),
    "sufficiency": ("segment_too_small", "insufficient_support", "minority_share"),
}
#: Registered, but no gate applies them yet.
RESERVED_REASONS = ("duplicate_semantic",)
REJECT_LABELS = {
    "product_mismatch": "제품불일치", "option_mismatch": "옵션불일치", "option_unstated": "옵션미기재", "renewal_cut": "리뉴얼이전", "recency_cut": "기간초과",
    "duplicate_content": "중복", "same_author": "동일작성자", "duplicate_semantic": "의미중복",
    "segment_too_small": "세그먼트과소", "insufficient_support": "과소근거", "minority_share": "소수방향",
}
LIMITATIONS = (
    "renewal_unobserved", "tagger_direction_error", "order_chosen_direction",
    "minority_within_tagger_noise", "single_dissent",
)
#: Reasons of the quote gate's own ledger, and its outcomes.
QUOTE_REASONS = {"quote_not_verbatim": "인용불일치", "quote_misattributed": "출처불일치", "no_verbatim_evidence": "근거소진"}
QUOTE_OUTCOMES = ("clean", "reduced", "substituted", "discarded")
SEVERITIES = ("critical", "high", "medium", "low")
FAILURES = (
    ("unsupported_claim", "critical", 1), ("misattribution", "critical", 2), ("polarity_mismatch", "high", 3), ("insufficient_evidence", "high", 4),
    ("missing_condition", "high", 5), ("overfit_question", "medium", 6), ("overbroad_question", "medium", 7), ("duplicate_claim", "low", 8),
)
STAGES = ("subject", "condition", "evidence", "direction", "sufficiency")
CLAIM_SCHEMA = "claim-v1"
DRAFT_FIELDS = ("aspect", "decisionAxis", "question", "verdict", "answer", "evidence")
DRAFT_EVIDENCE_FIELDS = ("reviewId", "quote", "stance")
#: First letter of each axis' codes.
CODE_PREFIX = {"skinType": "A", "skinTone": "B", "skinTrouble": "C"}
PROMO_TOKENS = (
    "기획", "단품", "리필", "본품", "NEW", "증정", "어워즈", "한정", "에디션", "단독", "홀리데이",
    "추천", "베스트", "콜라보", "추가", "수량", "SET",
)
UNIT_TOKENS = ("ml", "mL", "ML", "g", "G", "kg", "매", "입", "ea", "EA", "구", "개", "정", "팩", "세트")

RAW_REVIEW = (
    "reviewId BIGINT, content STRING, rating INT, reviewDate STRING, userName STRING, goodsNo STRING, "
    "requestedGoodsNo STRING, productName STRING, option STRING, skinType STRING, skinTone STRING, "
    "skinTrouble ARRAY<STRING>, reviewType STRING, isRepurchase BOOLEAN, isMonthUseReview BOOLEAN, "
    "isMonthOverReview BOOLEAN, hasPhoto BOOLEAN, usefulPoint DOUBLE, recommendCount INT, productKey STRING, "
    "category STRING, profileImageUrl STRING, reviewImages ARRAY<STRING>, reviewerRank INT, isTopReviewer BOOLEAN"
)
DROPPED_FIELDS = ("productKey", "category", "profileImageUrl", "reviewImages", "reviewerRank", "isTopReviewer")
RAW_FIELDS = (
    "content", "rating", "reviewDate", "reviewType", "isRepurchase", "isMonthUseReview", "isMonthOverReview", "hasPhoto", "usefulPoint", "recommendCount",
    "goodsNo", "requestedGoodsNo", "productName", "option", "userName", "skinType", "skinTone", "skinTrouble",
)
TAG = "reviewId BIGINT, aspect STRING, polarity STRING, snippet STRING, skinTypeHint STRING"


class ContractError(ValueError):
    """Rows break a contract; nothing is repaired silently."""


@dataclass(frozen=True)
class TrustPolicy:
    content_length: float = 0.6
    unique_content: float = 0.4
    on_topic: float = 0.5
    has_photo: float = 0.0
    usage_period: float = 0.0
    likes: float = 0.0
    floor_chars: int = 22
    cap_chars: int = 478
    shape: str = "sqrt"

    def __post_init__(self):
        weights = (self.content_length, self.unique_content, self.on_topic, self.has_photo, self.usage_period, self.likes)
        if min(weights) < 0 or sum(weights) <= 0 or self.cap_chars <= self.floor_chars or self.shape not in ("linear", "sqrt", "log"):
            raise ContractError("trust weights must be non-negative with a positive sum, and the ramp known")


@dataclass(frozen=True)
class SufficiencyPolicy:
    s_min: int = 8
    n_min: int = 8
    r_min: float = 0.10
    minority_min: int = 2

    def __post_init__(self):
        if not (self.n_min >= 1 and self.s_min >= self.n_min and 0 < self.r_min < 1 and self.minority_min >= 1):
            raise ContractError("s_min >= n_min >= 1 and 0 < r_min < 1 are needed")


@dataclass(frozen=True)
class QuotePolicy:
    """At least min_evidence quotes must stay; max_substitutions None: as many as were dropped."""

    min_evidence: int = 1
    max_substitutions: int | None = None

    def __post_init__(self):
        if isinstance(self.min_evidence, bool) or not isinstance(self.min_evidence, int) or self.min_evidence < 1:
            raise ContractError("min_evidence is an integer of at least 1; 0 would switch the gate off")
        if self.max_substitutions is not None and self.max_substitutions < 0:
            raise ContractError("max_substitutions is None or not negative")


@dataclass(frozen=True)
class NoisePolicy:
    flip_rate: float = 0.033
    alpha: float = 0.05


WINDOW_MONTHS = 24
SPLIT_ALPHA = 0.05
MAX_QUOTES = 8
MAX_ASPECTS = 5
TAG_BATCH = 20
