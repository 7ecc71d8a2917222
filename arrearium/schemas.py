"""Explicit schemas of the four raw tables, for CSV input."""

# Dates stay text here: they are parsed by parse_dates, which turns bad text into NULL.
RAW_SCHEMAS = {
    "customers": (
        "customer_id STRING, age INT, gender STRING, region STRING, city_tier STRING, "
        "employment_status STRING, employment_length_years INT, annual_income DOUBLE, "
        "credit_score INT, housing_status STRING, marital_status STRING, existing_debts_count INT"),
    "loans": (
        "loan_id STRING, customer_id STRING, loan_type STRING, loan_amount DOUBLE, "
        "interest_rate DOUBLE, loan_term_months INT, disbursement_date STRING, "
        "collateral_type STRING, collateral_value DOUBLE, loan_purpose STRING, "
        "origination_channel STRING"),
    "repayments": (
        "repayment_id STRING, loan_id STRING, customer_id STRING, total_installments_due INT, "
        "installments_paid INT, total_amount_paid DOUBLE, principal_paid DOUBLE, "
        "interest_paid DOUBLE, last_payment_date STRING, overdue_days INT, "
        "delinquency_bucket STRING, default_flag INT, default_date STRING"),
    "recovery_activities": (
        "recovery_id STRING, loan_id STRING, customer_id STRING, recovery_status STRING, "
        "primary_channel STRING, recovery_officer_id STRING, officer_name STRING, "
        "officer_designation STRING, contact_attempts INT, promise_to_pay_kept INT, "
        "settlement_discount_pct DOUBLE, recovered_amount DOUBLE, recovery_cost DOUBLE, "
        "recovery_date STRING"),
}
DATE_COLUMNS = {
    "loans": ["disbursement_date"],
    "repayments": ["last_payment_date", "default_date"],
    "recovery_activities": ["recovery_date"],
}
