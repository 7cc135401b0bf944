"""The rolling families and current values of the member feature table.

Expressions are plain SQL over the panel columns.  ``KIND`` of a family is "whole" (sums of whole
numbers in double columns), "int" (counts) or "ratio" (needs rounding when compared).
"""

from __future__ import annotations

from memberlytics.operators.features import Current
from memberlytics.operators.rolling import Rolling
from memberlytics.plans.bindings import CHANNELS, LINES


def ratio(a: str, b: str) -> str:
    return f"coalesce({a} / nullif({b}, 0), 0)"


def one_if(cond: str) -> str:
    return f"(CASE WHEN {cond} THEN 1 ELSE 0 END)"


EARNED = "(CASE WHEN bonus_flag = 'Y' THEN bonus_pct ELSE 0 END)"
N_LINES = " + ".join(one_if(f"{ln}_pv > 0") for ln in LINES)
N_CHANNELS = " + ".join(one_if(f"{ch}_pv > 0") for ch in CHANNELS)

# (current name, expression, treatment of the first row, [(stem of the family, agg)], kind)
_SPECS = [
    ("n_pv", "pv", "null", [("n_pv_sum", "sum")], "whole"),
    ("n_pct_pv_last3", ratio("last3_pv", "pv"), "null", [("n_pct_pv_last3_avg", "avg")], "ratio"),
    ("n_pv_nonzero", one_if("pv > 0"), "null", [("n_pv_nonzero_mths", "sum")], "int"),
    ("n_pct_stly_pv", ratio("(pv - stly_pv)", "stly_pv"), "null", [("n_pct_stly_pv_avg", "avg")], "ratio"),
    ("n_bv", "bv", "null", [("n_bv_sum", "sum")], "whole"),
    ("n_rev", "rev", "null", [("n_rev_sum", "sum")], "whole"),
    ("n_pct_rev_last3", ratio("last3_rev", "rev"), "null", [("n_pct_rev_last3_avg", "avg")], "ratio"),
    ("n_pct_stly_rev", ratio("(rev - stly_rev)", "rev"), "null", [("n_pct_stly_rev_avg", "avg")], "ratio"),
    ("n_bonus_pct", EARNED, "null", [("n_bonus_pct_avg", "avg"), ("n_bonus_pct_max", "max")], "int"),
    ("n_bonus_9plus", one_if("bonus_flag = 'Y' AND bonus_pct >= 9"), "null", [("n_bonus_9plus_sum", "sum")], "int"),
    ("n_bonus_flag", one_if("bonus_flag = 'Y'"), "null", [("n_bonus_flag_count", "sum")], "int"),
    ("n_bonus_gross", "bonus_gross", "null", [("n_bonus_gross_sum", "sum")], "whole"),
    ("n_pct_bonus_diff", ratio("bonus_diff", "bonus_gross"), "null", [("n_pct_bonus_diff_avg", "avg")], "ratio"),
    ("n_bonus_pers", "bonus_pers", "null", [("n_bonus_pers_sum", "sum")], "whole"),
    ("n_bonus_diff", "bonus_diff", "null", [("n_bonus_diff_sum", "sum")], "whole"),
    (None, one_if("bonus_gross > 0"), None, [("n_bonus_gross_nonzero_mths", "sum")], "int"),
    (None, one_if("bonus_pers > 0"), None, [("n_bonus_pers_nonzero_mths", "sum")], "int"),
    (None, one_if("bonus_diff > 0"), None, [("n_bonus_diff_nonzero_mths", "sum")], "int"),
    ("n_orders", "orders", "null", [("n_orders_sum", "sum")], "int"),
    ("n_orders_nonzero", one_if("orders > 0"), "zero", [("n_orders_nonzero_mths", "sum")], "int"),
    ("n_pct_orders_last3", ratio("last3_orders", "orders"), "null", [("n_pct_orders_last3_avg", "avg")], "ratio"),
    ("n_lines", f"({N_LINES})", "null", [("n_lines_avg", "avg")], "int"),
    *[(f"n_pct_pv_{x}", ratio(f"{x}_pv", "pv"), "null", [(f"n_pct_pv_{x}_avg", "avg")], "ratio") for x in LINES],
    *[(f"n_{x}_pv_nonzero", one_if(f"{x}_pv > 0"), "null", [(f"n_{x}_pv_nonzero_mths", "sum")], "int") for x in LINES],
    *[(f"n_{x}_{m}", f"{x}_{m}", "null", [(f"n_{x}_{m}_sum", "sum")], "whole") for m in ("pv", "bv", "rev") for x in LINES],
    *[(f"n_{x}_pv", f"{x}_pv", "null", [(f"n_{x}_pv_sum", "sum")], "whole") for x in CHANNELS],
    *[(f"n_pct_pv_{x}", ratio(f"{x}_pv", "pv"), "null", [(f"n_pct_pv_{x}_avg", "avg")], "ratio") for x in CHANNELS],
    *[(f"n_{x}_pv_nonzero", one_if(f"{x}_pv > 0"), "zero", [(f"n_{x}_pv_nonzero_mths", "sum")], "int") for x in CHANNELS],
    ("n_channels", f"({N_CHANNELS})", "null", [("n_channels_max", "max")], "int"),
    *[(f"n_{x}_{m}", f"{x}_{m}", "null", [(f"n_{x}_{m}_sum", "sum")], "whole") for m in ("bv", "rev") for x in CHANNELS],
    ("n_group_pv", "group_pv", "null", [("n_group_pv_sum", "sum")], "whole"),
    ("n_pv_ratio", ratio("pv", "group_pv"), "zero", [], "ratio"),
    ("n_qual_legs", "qual_legs", "null", [("n_qual_legs_avg", "avg")], "int"),
    ("n_q", one_if("q_flag = 'Y'"), "zero", [("n_q_sum", "sum")], "int"),
    ("n_qv", one_if("qv_flag = 'Y'"), "zero", [("n_qv_sum", "sum")], "int"),
    ("n_q1", one_if("q1_flag = 'Y'"), "zero", [("n_q1_sum", "sum")], "int"),
    ("n_q2", one_if("q2_flag = 'Y'"), "zero", [("n_q2_sum", "sum")], "int"),
    ("n_sponsor", one_if("sponsor_flag = 'Y'"), "zero", [("n_sponsor_sum", "sum")], "int"),
    ("i_rank", "rank", "null", [("i_rank_max", "max")], "int"),
    ("n_rank_achieved", one_if("rank > 0"), "null", [("n_rank_achieved_sum", "sum")], "int"),
    ("n_downline_pv", "downline_pv", "null", [("n_downline_pv_avg", "avg")], "whole"),
    ("n_downline_sellers", "coalesce(dl_sellers, 0)", "null", [("n_downline_sellers_avg", "avg")], "int"),
    ("n_pct_downline_sellers", ratio("dl_sellers", "dl_all"), "null", [("n_pct_downline_sellers_avg", "avg")], "ratio"),
    ("n_downline_customers", "coalesce(dl_customers, 0)", "null", [("n_downline_customers_avg", "avg")], "int"),
    ("n_downline_repeat", "coalesce(dl_customers_repeat, 0)", "null", [("n_downline_repeat_avg", "avg")], "int"),
    ("n_promo_sku", "coalesce(n_promo_sku, 0)", None, [("n_promo_sku_avg", "avg")], "int"),
]

CURRENT = [Current(name, expr, prev) for name, expr, prev, _, _ in _SPECS if name]
ROLLED = [Rolling(stem, expr, agg) for _, expr, _, fams, _ in _SPECS for stem, agg in fams]
KIND = {stem: kind for _, _, _, fams, kind in _SPECS for stem, _ in fams}

# Families whose value is a ratio of two rolling sums, or a rolling sum against a joined constant.
RATIOS = [
    Rolling("n_pv_ratio", "pv", over="group_pv"),
    Rolling("n_pct_qv", one_if("qv_flag = 'Y'"), over=one_if("q_flag = 'Y'")),
    Rolling("n_pct_q1", one_if("q1_flag = 'Y'"), over=one_if("q_flag = 'Y'")),
    Rolling("n_pct_q2", one_if("q2_flag = 'Y'"), over=one_if("q_flag = 'Y'")),
    Rolling("n_pct_income", "bonus_gross", per="income"),
]
FAMILIES = ROLLED + RATIOS

ENGAGED = ("purchase", "view", "signup", "click", "error")
# Families with momentum and year-over-year columns.
TRACKED = [
    "n_pv_sum", "n_bv_sum", "n_rev_sum", "n_bonus_pct_max", "n_bonus_9plus_sum", "n_bonus_flag_count",
    "n_bonus_gross_sum", "n_bonus_pers_sum", "n_bonus_diff_sum", "n_orders_sum", "n_orders_nonzero_mths",
    *[f"n_{x}_pv_sum" for x in LINES],
    *[f"n_{x}_pv_sum" for x in CHANNELS],
    *[f"n_{x}_bv_sum" for x in CHANNELS],
    "n_q_sum", "n_sponsor_sum", "n_sellers_added_past",
    *[f"n_lag_{t}_sum" for t in ENGAGED],
]
