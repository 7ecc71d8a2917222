"""Labels, limits, aliases and texts that results must reproduce exactly."""

# --- column groups -----------------------------------------------------------------------------

# What a loan without any recovery record is filled with.
NO_RECOVERY_DEFAULTS = {
    "recovery_status": "No Delinquency / Not Applicable",
    "primary_channel": "None",
    "recovery_officer_id": "None",
    "officer_name": "None",
    "officer_designation": "None",
    "contact_attempts": 0,
    "promise_to_pay_kept": 0,
    "settlement_discount_pct": 0.0,
    "recovered_amount": 0.0,
    "recovery_cost": 0.0,
}

# Recovery outcomes that count as recovered and as not recovered.
RECOVERED_STATUSES = ["Fully Recovered", "Partially Recovered"]
UNRECOVERED_STATUSES = ["Written Off", "Legal Escalation", "In Progress"]

# Model inputs.
MODEL_NUMERIC = [
    "credit_score", "annual_income", "loan_amount", "interest_rate", "loan_term_months",
    "overdue_days", "dti_ratio", "ltv_ratio", "is_secured", "contact_attempts",
    "promise_to_pay_kept", "delinquency_severity_score", "existing_debts_count", "age",
]
MODEL_CATEGORICAL = [
    "loan_type", "region", "city_tier", "employment_status", "housing_status",
    "collateral_type", "origination_channel", "primary_channel",
]

# Clustering inputs.
SEGMENT_FEATURES = [
    "credit_score", "annual_income", "loan_amount", "interest_rate",
    "overdue_days", "dti_ratio", "installments_paid", "delinquency_severity_score",
]

# Columns of the correlation report.
CORRELATION_COLUMNS = [
    "age", "annual_income", "credit_score", "loan_amount", "interest_rate", "loan_term_months",
    "overdue_days", "dti_ratio", "ltv_ratio", "contact_attempts", "recovered_amount",
    "recovery_cost", "default_flag",
]

# Columns a model may not use (identifiers and leakage) and the targets.
NON_FEATURE_COLUMNS = [
    "customer_id", "loan_id", "recovery_id", "repayment_id", "recovery_status", "recovery_date",
    "last_payment_date", "default_date", "disbursement_date", "delinquency_bucket",
    "officer_name", "recovery_officer_id", "officer_designation", "loan_purpose",
    "settlement_discount_pct", "recovery_cost",
]
TARGET_COLUMNS = [
    "recovery_status_binary", "recovered_amount", "net_recovery_amount", "recovery_rate_pct",
    "default_flag", "loyal_customer",
]

# --- banding -----------------------------------------------------------------------------------

# Fixed values: (upper edge, label), right-closed, starting above 0.
CREDIT_TIERS = [
    (549, "Deep Subprime (<550)"),
    (649, "Subprime (550-649)"),
    (699, "Near-Prime (650-699)"),
    (749, "Prime (700-749)"),
    (900, "Super-Prime (750+)"),
]

# Fixed values: (upper edge of days past due, label); the last label has no upper edge.
DELINQUENCY_STAGES = [
    (0, "Current"),
    (30, "1-30 DPD (SMA-0)"),
    (60, "31-60 DPD (SMA-1)"),
    (90, "61-90 DPD (SMA-2)"),
    (None, "90+ DPD (NPA / Default)"),
]
STAGE_LABELS = [label for _, label in DELINQUENCY_STAGES]

# Fixed values: (upper edge of the 0-100 risk score, label), right-closed.
RISK_BANDS = [
    (30.0, "🟢 Low Risk (Grade A)"),
    (55.0, "🟡 Moderate Risk (Grade B)"),
    (75.0, "🟠 High Risk (Grade C)"),
    (100.1, "🔴 Critical / NPA (Grade D)"),
]

# Grade, lower edge of the recovery probability (None = decision threshold),
# label, strategy.
RISK_GRADES = [
    ("A", 0.75, "Low Risk (Grade A - High Recovery)",
     "Digital Automation & Self-Curative AI Links"),
    ("B", 0.50, "Moderate Risk (Grade B - Restructure)",
     "Tele-Counseling & Term Restructuring"),
    ("C", None, "Elevated Risk (Grade C - Targeted Intervention)",
     "Field Visit & Standardized Haircut"),
    ("D", 0.0, "Critical Risk (Grade D - Unrecoverable / NPA)",
     "Immediate Legal Escalation / Debt Recovery Tribunal"),
]
OPTIMAL_THRESHOLD = 0.175

# Persona names.
PERSONA_PRIME = "Prime / Low-Risk Self-Curative"
PERSONA_SECURED = "Secured High-Value / Asset-Backed"
PERSONA_CHRONIC = "Chronic Delinquent / High Risk (Agency/Legal)"
PERSONA_DISTRESSED = "Distressed but Responsive (Restructure)"

# Persona, risk profile, recommended action, cap on the settlement discount (%).
PERSONA_PLAYBOOK = [
    (PERSONA_PRIME, "700+ Score, Low", "AI SMS/Email only", 20.0),
    (PERSONA_DISTRESSED, "630-690, Medium", "Restructure / Haircut", 15.0),
    (PERSONA_SECURED, "Asset-Backed", "Repossession Notice", 20.0),
    (PERSONA_CHRONIC, "<600 Score, High", "Agency / Legal DRT", 25.0),
]

# Rank, lower edge of probability, upper edge of days past due, channel, window.
COLLECTOR_MATRIX = [
    (1, 0.75, 30, "AI Digital Bot & Automated WhatsApp", "7 - 14 Days"),
    (2, 0.55, 60, "Inside Tele-Calling & Debt Counselor", "15 - 30 Days"),
    (3, 0.35, 90, "Specialized Field Visit Officer", "30 - 45 Days"),
    (4, 0.00, None, "External Agency & Legal Recovery Counsel", "60 - 90 Days"),
]

# Reason texts of an adverse decision, by feature.
ADVERSE_REASONS = [
    ("overdue_days", "Number of consecutive days past due"),
    ("promise_to_pay_kept", "Broken promise-to-pay commitments"),
    ("dti_ratio", "High aggregate debt-to-income ratio"),
    ("credit_score", "Low bureau credit score"),
    ("ltv_ratio", "High loan-to-value ratio"),
    ("contact_attempts", "Repeated unsuccessful contact attempts"),
]

# Collateral texts that mean "unsecured" besides NULL.
UNSECURED_LABELS = ["None"]

# --- standardiser ------------------------------------------------------------------------------

# Canonical column -> accepted names, in order of preference.
COLUMN_ALIASES = {
    "loan_amount": ["loan_amount", "loan_amt", "principal_amount", "disbursed_amount",
                    "outstanding_balance", "loan_balance", "balance", "amount", "principal"],
    "annual_income": ["annual_income", "income", "yearly_income", "salary", "gross_income",
                      "applicant_income", "monthly_income"],
    "credit_score": ["credit_score", "cibil_score", "fico_score", "bureau_score",
                     "credit_rating", "score", "risk_score"],
    "interest_rate": ["interest_rate", "int_rate", "rate", "interest", "roi",
                      "interest_rate_pct"],
    "loan_term_months": ["loan_term_months", "loan_term", "term_months", "term",
                         "tenure_months", "tenure", "loan_duration_months"],
    "overdue_days": ["overdue_days", "dpd", "days_past_due", "delinquency_days", "delay_days",
                     "days_overdue", "overdue_duration"],
    "loan_type": ["loan_type", "product_type", "loan_category", "product", "loan_name", "type"],
    "region": ["region", "zone", "state", "location", "city", "territory", "geography"],
    "primary_channel": ["primary_channel", "recovery_channel", "channel", "collection_channel",
                        "collection_method", "recovery_method", "contact_channel"],
    "recovery_cost": ["recovery_cost", "collection_cost", "cost", "expense", "direct_cost",
                      "operating_cost"],
    "recovered_amount": ["recovered_amount", "amount_recovered", "recovery_amount",
                         "total_recovered", "recovered", "collection_amount", "net_recovered"],
    "contact_attempts": ["contact_attempts", "attempts", "calls_made", "followups",
                         "contact_count", "recovery_agent_experience"],
    "settlement_discount_pct": ["settlement_discount_pct", "settlement_offered",
                                "settlement_discount", "discount_pct", "haircut_pct",
                                "discount", "settlement_pct"],
    "default_flag": ["default_flag", "is_default", "defaulted", "npa_flag", "default",
                     "bad_loan"],
}

# Replacement for a number that is missing or unreadable.
NUMERIC_DEFAULTS = {
    "loan_amount": 25000.0,
    "annual_income": 60000.0,
    "credit_score": 675.0,
    "interest_rate": 12.5,
    "loan_term_months": 36,
    "overdue_days": 0,
    "recovery_cost": 0.0,
}

# Constants of columns that are absent altogether.
ABSENT_DEFAULTS = {
    "loan_amount": 25000.0,
    "annual_income": 60000.0,
    "interest_rate": 12.5,
    "loan_term_months": 36,
    "overdue_days": 0,
    "recovery_cost": 0.0,
    "loan_type": "Personal Loan",
    "region": "General",
    "primary_channel": "Tele-Calling & Counseling",
}
ABSENT_CREDIT_SCORE = 680.0

# Words that mark a recovered account, by text column.
RECOVERY_KEYWORDS = {
    "recovery_status": ["fully", "partially", "recovered", "resolved", "paid", "closed",
                        "settled"],
    "repayment_history": ["good", "paid", "on-time", "standard", "resolved"],
    "customer_response": ["paid", "settled", "promised", "cooperative"],
}

# Fixed value: pattern of a defaulted delinquency stage.
DEFAULT_STAGE_PATTERN = "(?i)NPA|Default|90\\+"

# --- scenarios ---------------------------------------------------------------------------------

# The three reference borrowers.
SCENARIO_COLUMNS = ["scenario", "credit_score", "annual_income", "loan_amount", "interest_rate",
                    "loan_term_months", "overdue_days", "dti_ratio", "ltv_ratio", "is_secured",
                    "contact_attempts", "promise_to_pay_kept", "existing_debts_count", "age",
                    "loan_type", "collateral_type", "primary_channel", "outstanding_principal",
                    "settlement_discount_pct"]
SCENARIOS = [
    ("A", 740, 85000.0, 30000.0, 8.5, 60, 32, 0.24, 0.60, 1, 2, 1, 1, 44, "Auto Loan",
     "Vehicle", "AI Voice Bot & SMS", 21000.0, 5.0),
    ("B", 635, 48000.0, 20000.0, 14.0, 36, 68, 0.44, 0.85, 0, 6, 0, 3, 32, "Personal Loan",
     "None", "Tele-Calling & Counseling", 16200.0, 15.0),
    ("C", 490, 26000.0, 18000.0, 19.5, 24, 180, 0.65, 0.95, 0, 16, 0, 6, 26, "Personal Loan",
     "None", "External Recovery Agency", 17800.0, 25.0),
]
# Fields the three borrowers share.
SCENARIO_COMMON = {
    "region": "North",
    "city_tier": "Tier 1",
    "employment_status": "Salaried - Corporate",
    "housing_status": "Owned",
    "origination_channel": "Branch Banking",
}
