"""Fixed values of the oracle: stated here once more, so that a wrong one in
the engine does not pass on both sides."""

# Override-note rules in order; a null category takes the ticket reference
NOTES = (
    ("LOSTSTOLENCARD", "Lost_Stolen_Card"),
    ("LOST/STOLEN", "Lost_Stolen_Card"),
    ("CHARGEBACKS", "Chargebacks"),
    ("ORDERDISPUTES", "Order_Disputes"),
    ("HARDSHIP", "Hardship"),
    ("COMPLAINT", "Complaint"),
    ("TECHISSUE", "Tech Issue"),
    ("CAPITALONE", "Capital One"),
    ("DISASTER", "Disaster"),
    ("GOODWILL", "Goodwill"),
    ("GOOD WILL", "Goodwill"),
    ("INCIDENT REMEDIATION", None),
)
TICKET = "#[^/ ]*"
NO_RULE = "Others"

# Status reasons that count as an order attempt
ATTEMPTS = ("APPROVED", "INSUFFICIENT_FUNDS", "INVALID_PAYMENT_DETAILS", "FRAUD_RULE_BREACH", "DECLINED")

# Columns of the master in order: name (that of the feature, mostly with _v3), feature, default (~: a space), type
MASTER = """
c_best_payment_type                                 fe18    'DEBIT'                VARCHAR
c_order_cnt_180d_v3                                 fe19    0                      BIGINT
c_topaz_decl_insufficent_funds_cnt_180d_v3          fe19    0                      BIGINT
c_order_attempt_cnt_180d_v3                         fe19    0                      BIGINT
c_ontime_pymt_cnt_180d_v3                           fe27    0                      BIGINT
c_ontime_pymt_cnt_llate_180d_v3                     fe28    0                      BIGINT
c_day_late_pymt_max_cnt_180d_v3                     fe28    0                      BIGINT
c_day_late_pymt_tot_cnt_180d_v3                     fe28    0                      BIGINT
c_latest_approved_credit_limit_v3                   fe10    0                      DECIMAL(10,2)
c_earliest_late_pymt_due_date_360d_v3               fe24    '1969-12-31'           DATE
c_latest_late_pymt_due_date_360d_v3                 fe24    '1969-12-31'           DATE
c_late_fee_paid_amount_360d_v3                      home17  0                      DECIMAL(20,2)
c_late_fee_paid_amount_90d_v3                       home17  0                      DECIMAL(20,2)
c_late_fee_paid_cnt_360d_v3                         home17  0                      BIGINT
c_late_fee_paid_cnt_90d_v3                          home17  0                      BIGINT
c_first_late_fee_paid_datetime_360d_v3              home17  '1969-12-31~11:59:59'  VARCHAR
c_first_late_fee_paid_datetime_90d_v3               home17  '1969-12-31~11:59:59'  VARCHAR
c_max_util_amt_after_limit_change_180d_v3           fe32    0                      DECIMAL(20,2)
c_day_late_pymt_max_cnt_after_limit_change_360d_v3  fe30    0                      BIGINT
c_latest_instal_due_date_360d_v3                    fe25    '1969-12-31'           DATE
c_latest_instal_postpone_due_date_360d_v3           fe25    '1969-12-31'           DATE
c_latest_late_expt_date_360d_v3                     fe29    '1969-12-31'           DATE
c_latest_late_expt_goodwill_date_360d_v3            fe29    '1969-12-31'           DATE
c_order_amt_180d_v3                                 fe21    0                      DECIMAL(20,2)
c_order_amt_percentile_180d_v3                      fe21    0                      DOUBLE
c_prior_credit_limit_2d_v3                          home20  0                      DECIMAL(10,2)
c_prior_credit_limit_3d_v3                          home20  0                      DECIMAL(10,2)
c_prior_credit_limit_10d_v3                         home20  0                      DECIMAL(10,2)
c_prior_credit_limit_30d_v3                         home20  0                      DECIMAL(10,2)
c_prior_credit_limit_90d_v3                         home20  0                      DECIMAL(10,2)
c_prior_credit_limit_180d_v3                        home20  0                      DECIMAL(10,2)
c_late_fee_waived_amount_360d_v3                    home17  0                      DECIMAL(20,2)
c_late_fee_waived_amount_90d_v3                     home17  0                      DECIMAL(20,2)
c_late_fee_waived_cnt_360d_v3                       home17  0                      BIGINT
c_late_fee_waived_cnt_90d_v3                        home17  0                      BIGINT
c_late_fee_refunded_amount_360d_v3                  home17  0                      DECIMAL(20,2)
c_late_fee_refunded_amount_90d_v3                   home17  0                      DECIMAL(20,2)
c_late_fee_refunded_cnt_360d_v3                     home17  0                      BIGINT
c_late_fee_refunded_cnt_90d_v3                      home17  0                      BIGINT
"""

# Fixed values of the adapters
EVENT_SHIFT_DAYS = 8217
BACKFILL_FROM = "2001-03-01"
LIMIT_DAYS = (1, 2, 3, 10, 30, 90, 180)
OVERRIDE_NOTES = (
    "LostStolenCard reported",
    "Chargebacks batch",
    "OrderDisputes queue",
    "hardship plan",
    "Complaint by phone",
    "TechIssue at checkout",
    "CapitalOne migration",
    "Disaster relief",
    "good will gesture",
    "Incident Remediation #INC42/x",
    "manual adjustment",
)
