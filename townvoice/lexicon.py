"""Search terms whose mentions are counted, as (category, term, output name)."""

from __future__ import annotations

Lexicon = list[tuple[str, str, str]]

# Terms, output names and their order are the table contract of the
# summary. Spellings are part of the contract.
TERMS = {
    "accident": {
        "화재": "fire", "멈춤": "stopped", "교통": "traffic", "충돌": "collision",
        "추돌": "rear_end", "전복": "rollover", "보행자": "pedestrian",
        "자전거": "bicycle", "이륜차": "motorcycle", "도로이탈": "road_departure",
        "신호위반": "signal_violation", "과속": "speeding", "급제동": "hard_braking",
        "급가속": "hard_acceleration", "급차선변경": "lane_change",
        "고장": "mechanical_failure", "타이어펑크": "tire_blowout",
        "침수": "flooding", "낙하물": "falling_object",
        "야생동물": "wildlife_collision",
    },
    "brand": {
        "기아": "kia", "현대": "hyundai", "bmw": "bmw", "혼다": "honda",
        "아우디": "audi", "테슬라": "tesla",
    },
    "model": {
        "i4": "i4", "G80": "genessis", "타이칸": "taycan", "트론": "e_tron",
        "ev6": "ev6",
    },
    "ev_issue": {
        "배터리": "battery", "방전": "drain", "충전": "charging",
        "전원 차단": "power_cutoff", "수명": "battery_degradation",
        "손실": "power_loss", "인버터": "inverter_failure",
        "모터": "motor_failure", "BMS": "bms_error", "소프트웨어": "software_bug",
        "자율주행": "autopilot_malfunction", "충전포트": "charging_port_failure",
        "에어컨": "hvac_failure", "냉각": "cooling_system_fault",
    },
}

DEFAULT_LEXICON: Lexicon = [
    (category, term, name) for category, terms in TERMS.items() for term, name in terms.items()
]


def of_category(lexicon: Lexicon, category: str) -> Lexicon:
    return [entry for entry in lexicon if entry[0] == category]


def names(lexicon: Lexicon, *categories: str) -> list[str]:
    return [name for category, _, name in lexicon if not categories or category in categories]
