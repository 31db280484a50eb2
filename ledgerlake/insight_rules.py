"""Rules of the insight views as data: thresholds, points, rates and texts.

A rule is (outcome, tests); all tests of a rule must hold, the first rule that holds
decides, and a list ends with a rule without tests. A test is (column, sign, value);
a test on a missing value does not hold, "missing" asks for exactly that. Texts are
whole templates; {name} stands for a value that the view computes.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: thresholds, points, labels and texts
# ---------------------------------------------------------------------------

HEALTH_POINTS = {
    "essential": [(30, [("essential_percent", ">=", 30), ("essential_percent", "<=", 40)]),
                  (25, [("essential_percent", ">=", 25), ("essential_percent", "<=", 30)]),
                  (25, [("essential_percent", ">=", 40), ("essential_percent", "<=", 45)]),
                  (20, [("essential_percent", ">=", 20), ("essential_percent", "<=", 25)]),
                  (10, [])],
    "discretionary": [(30, [("discretionary_percent", "<", 25)]), (25, [("discretionary_percent", "<", 35)]),
                      (20, [("discretionary_percent", "<", 45)]), (15, [("discretionary_percent", "<", 55)]),
                      (5, [])],
    "change": [(15, [("mom_percent_change", "missing", None)]), (20, [("mom_percent_change", "<=", 0)]),
               (15, [("mom_percent_change", "<", 10)]), (10, [("mom_percent_change", "<", 20)]), (5, [])],
    "variety": [(20, [("unique_categories_count", ">=", 7)]), (15, [("unique_categories_count", ">=", 5)]),
                (10, [("unique_categories_count", ">=", 3)]), (5, [])],
}
# (grade, least sum, points if the essential share is in the range, else 10; points if the
# discretionary share is below the limit, else 5)
HEALTH_GRADES = [("🌟 EXCELLENT", 75, (30, 30, 40), (25, 35)),
                 ("✅ GOOD", 60, (25, 25, 40), (20, 45)),
                 ("⚡ FAIR", 45, (20, 20, None), (15, 55))]
HEALTH_GRADE_ELSE, HEALTH_ESSENTIAL_ELSE, HEALTH_DISCRETIONARY_ELSE = "⚠️ NEEDS IMPROVEMENT", 10, 5
HEALTH_ISSUES = [("issue_1", "🔴 High Discretionary", ("discretionary_percent", ">", 50)),
                 ("issue_2", "🔴 Low Essential", ("essential_percent", "<", 20)),
                 ("issue_3", "🔴 Spending Spike", ("mom_percent_change", ">", 20))]
HEALTH_SAVING_FROM, HEALTHY_DISCRETIONARY = 40, 35

# category: (threshold, title, detail)
RECOMMENDATIONS = {
    "Shopping": (500, "🛍️ Reduce Shopping Spending",
                 "You spent ${total} on shopping this month. Try limiting shopping trips to 2x per month and set a $300 budget. Potential savings: ${saving}/month."),
    "Dining": (300, "🍽️ Cook More at Home",
               "You spent ${total} dining out ({count} times). Cooking at home 3-4 more times per week could save ${saving}/month."),
    "Entertainment": (200, "🎬 Reduce Entertainment Costs",
                      "Entertainment costs are ${total}/month. Consider free alternatives like parks, libraries, or home movie nights. Potential savings: ${saving}/month."),
    "Transport": (250, "🚗 Optimize Transportation",
                  "Transportation costs: ${total}/month. Try carpooling, public transit, or combining trips. Could save ${saving}/month."),
    "Food": (400, "🥗 Plan Meals Better",
             "Food spending: ${total}/month. Meal planning and buying in bulk can reduce costs by 20-30%. Potential savings: ${saving}/month."),
}
RECOMMENDATION_ELSE = ("💡 Review {category} Spending",
                       "Review your {category} spending (${total}/month) for optimization opportunities.")
RECOMMENDATION_GROUPS, RECOMMENDATION_LEAST = ("Discretionary", "Transport", "Other"), 100
RECOMMENDATION_ORDER = [(1, [("discretionary_percent", ">", 50)]), (2, [("top_category", "=", "Shopping")]),
                        (3, [("top_category", "=", "Dining")]), (4, [("weekend_spending_percent", ">", 40)]), (5, [])]
RECOMMENDATION_PRIORITY = [("HIGH_PRIORITY", [("discretionary_percent", ">", 50)]),
                           ("MEDIUM_PRIORITY", [("discretionary_percent", ">", 40)]), ("LOW_PRIORITY", [])]
DIFFICULTY = [("EASY", [("category_name", "in", ("Shopping", "Entertainment"))]),
              ("MODERATE", [("category_name", "in", ("Dining", "Food"))]),
              ("HARD", [("category_name", "in", ("Transport", "Healthcare"))]), ("MODERATE", [])]
SAVINGS_RATES = {"Shopping": "0.30", "Dining": "0.40", "Entertainment": "0.35", "Transport": "0.25", "Food": "0.25"}
SAVINGS_RATE_ELSE = "0.15"
TARGET_RATES = {"Shopping": "0.70", "Dining": "0.60", "Entertainment": "0.65", "Transport": "0.75", "Food": "0.75"}
TARGET_RATE_ELSE = "0.85"

# ((type, title, message, action), tests)
ALERTS = [
    (("EXCESSIVE_DISCRETIONARY", "🚨 URGENT: Excessive Discretionary Spending ({share}%)",
      "You spent {share}% on discretionary items (${discretionary}). Target is <35%. Reduce by ${excess} to reach healthy levels.",
      "IMMEDIATE: Cut discretionary by 30%"), [("discretionary_percent", ">", 60)]),
    (("HIGH_DISCRETIONARY", "⚠️ WARNING: High Discretionary Spending ({share}%)",
      "Discretionary spending at {share}% (${discretionary}). Consider reducing by 15% to improve financial health. Potential savings: ${some}/month.",
      "THIS WEEK: Reduce discretionary by 15%"), [("discretionary_percent", ">", 50)]),
    (("SPENDING_SPIKE", "📈 ALERT: Major Spending Spike (+{change}%)",
      "Your spending jumped {change}% this month (from ${before} to ${total}). Review recent purchases and identify one-time expenses.",
      "IMMEDIATE: Freeze non-essential purchases"), [("mom_percent_change", ">", 30)]),
    (("SPENDING_INCREASE", "📊 NOTICE: Spending Increased (+{change}%)",
      "Spending increased {change}% (${more} more than last month). Monitor closely and adjust if trend continues.",
      "THIS WEEK: Review and reduce spending"), [("mom_percent_change", ">", 20)]),
    (("CATEGORY_SPIKE", "💥 SPIKE: {spike} spending surged (+{spike_change}%)",
      "{spike} spending jumped {spike_change}% to ${spike_total}. This category needs immediate attention. Set a monthly limit and track daily.",
      "IMMEDIATE: Set {spike} budget limit"), [("spike_change", ">", 50)]),
    (("CONCENTRATION_RISK", "🎯 RISK: {top} dominates spending ({top_share}%)",
      "{top} represents {top_share}% of your spending (${top_total}). High concentration in one category increases financial risk. Diversify spending.",
      "THIS MONTH: Diversify spending categories"), [("top_category_percent", ">", 50)]),
    (("GENERAL_WARNING", "💡 TIP: Review your spending patterns",
      "Review your spending patterns for optimization opportunities.", "REVIEW: Monitor spending trends"), []),
]
ALERT_SEVERITY = [("HIGH", [("discretionary_percent", ">", 60)]), ("HIGH", [("mom_percent_change", ">", 30)]),
                  ("MEDIUM", [("discretionary_percent", ">", 50)]), ("MEDIUM", [("mom_percent_change", ">", 20)]), ("LOW", [])]
ALERT_SHARE_CUT = "0.15"

# ((summary, action), tests)
INSIGHTS = [
    (("🎯 HIGH IMPACT: {category} is {share}% of total spending. Major savings opportunity!",
      "Set category budget at ${budget}/month (30% reduction)"),
     [("category_group", "=", "Discretionary"), ("percent_of_total_spending", ">", 30)]),
    (("📈 TRENDING UP: {category} increased {change}% MoM. Address before it becomes habit.",
      "Freeze spending in this category for 1 week"),
     [("category_group", "=", "Discretionary"), ("mom_percent_change", ">", 20)]),
    (("💰 BIG SPENDER: {category} totals ${total}/month. Review all transactions.",
      "Review each transaction and eliminate 25% of purchases"),
     [("category_group", "=", "Discretionary"), ("total_spending", ">", 5000)]),
    (("⚠️ ESSENTIAL SPIKE: {category} up {change}%. Investigate for wastage or price increases.",
      "Audit for wastage, compare prices, consider alternatives"),
     [("category_group", "=", "Essential"), ("mom_percent_change", ">", 30)]),
    (("🔝 TOP 3: {category} is #{rank} category. Monitor closely.", "Continue monitoring"),
     [("category_rank_current", "<=", 3)]),
    (("✅ STABLE: {category} spending is controlled.", "Continue monitoring"), []),
]
INSIGHT_BUDGET_RATE = "0.70"
OPPORTUNITY_SHARE_CAP = (30, 40)  # a share above the first counts as the second
OPPORTUNITY_POINTS = {
    "change": [(30, [("mom_percent_change", ">", 20)]), (20, [("mom_percent_change", ">", 10)]),
               (10, [("mom_percent_change", ">", 0)]), (0, [])],
    "size": [(30, [("total_spending", ">", 10000)]), (20, [("total_spending", ">", 5000)]),
             (10, [("total_spending", ">", 2000)]), (0, [])],
}

PLAN_STATUS = [("🌟 EXCELLENT", [("discretionary_percent", "<", 25), ("essential_percent", ">=", 30), ("essential_percent", "<=", 40)]),
               ("✅ GOOD", [("discretionary_percent", "<", 35), ("essential_percent", ">=", 25), ("essential_percent", "<=", 45)]),
               ("⚡ FAIR", [("discretionary_percent", "<", 45)]), ("⚠️ POOR", [("discretionary_percent", "<", 55)]),
               ("🚨 CRITICAL", [])]
PLAN_TEXTS = {
    "action_1_priority": [
        ("1️⃣ URGENT: Reduce {top} spending by 30% (save ${top_cut}/mo)", [("top_category_percent", ">", 40)]),
        ("1️⃣ URGENT: Cut all discretionary by 25% (save ${discretionary_cut}/mo)", [("discretionary_percent", ">", 50)]),
        ("1️⃣ HIGH: Reduce weekend spending (currently {weekend}%)", [("weekend_spending_percent", ">", 40)]),
        ("1️⃣ LOW: Continue monitoring spending", [])],
    "action_2_priority": [
        ("2️⃣ HIGH: Review top 3 categories: {list}", [("discretionary_percent", ">", 50)]),
        ("2️⃣ MEDIUM: Too many transactions ({count}). Consolidate purchases.", [("transaction_count", ">", 100)]),
        ("2️⃣ MEDIUM: Plan weekend activities better to control impulse spending", [("weekend_spending_percent", ">", 35)]),
        ("2️⃣ LOW: Maintain current spending discipline", [])],
    "action_3_priority": [
        ("3️⃣ MEDIUM: Simplify spending - too diverse ({categories} categories)", [("unique_categories_count", ">", 8)]),
        ("3️⃣ MEDIUM: Increase essential spending proportion (currently {essential}%)", [("essential_percent", "<", 25)]),
        ("3️⃣ LOW: Track weekly spending and review monthly", [])],
    "lifestyle_change_1": [
        ('🛍️ Implement "24-hour rule" for purchases over $50', [("top_category", "=", "Shopping")]),
        ("🍳 Meal prep Sundays + pack lunch 3x/week", [("top_category", "=", "Dining")]),
        ("🎬 Swap paid activities for free alternatives", [("top_category", "=", "Entertainment")]),
        ("🚴 Walk/bike short distances + carpool when possible", [("top_category", "=", "Transport")]),
        ("💡 Track every purchase for 30 days", [])],
    "lifestyle_change_2": [
        ("📅 Plan weekend budget on Friday ($X limit)", [("weekend_spending_percent", ">", 40)]),
        ("🛒 Batch shopping trips (1x/week max)", [("transaction_count", ">", 100)]),
        ("💰 Set weekly spending limits and stick to them", [])],
    "lifestyle_change_3": [("📊 Review spending every Friday + adjust next week accordingly", [])],
    "recommended_review_period": [("30 days", [])],
}
PLAN_RATES = {"target": "0.35", "top_cut": "0.30", "discretionary_cut": "0.25", "week": "0.25"}
# ---------------------------------------------------------------------------
