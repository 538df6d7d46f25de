"""These must equal the loan-cleaning study's values for the same results.

Kept together, in their natural order, as plain text.
"""

# --- fixed values: loan status groups -------------------------------------------------
# Statuses that count as a defaulted (bad) loan; the label is 1 for these, else 0.
DEFAULT_STATUSES = (
    "Default",
    "Charged Off",
    "Late (31-120 days)",
    "Late (16-30 days)",
    "Does not meet the credit policy. Status:Charged Off",
    "In Grace Period",
)
# A NULL total-collection amount means 0 for loans in these statuses.
ZERO_COLL_STATUSES = (
    "Fully Paid",
    "Charged Off",
    "Does not meet the credit policy. Status:Fully Paid",
)
# A NULL total-current-balance means 0 for loans in these statuses.
ZERO_BAL_STATUSES = ("Fully Paid", "Charged Off")

# --- fixed values: row rules for shifted columns ----------------------------------------
# (column, pattern) in the order they are applied; patterns are Java regexes, unanchored
# unless they say otherwise.
ROW_RULES = (
    ("dti", "[0-9]+"),
    ("delinq_2yrs", "[0-9]+"),
    ("addr_state", "^[A-Z]{0,3}$"),
)

# --- fixed values: text parsing -----------------------------------------------------------
EMP_LENGTH_STRIP = "years|year|\\+|\\<"
TERM_DIGITS = "\\d+"

# --- fixed values: column drop lists ------------------------------------------------------
# Step-1 sparse columns (under 90% complete). 'il_util has' is the original's misspelling
# of 'il_util'; kept so a non-strict drop behaves as the original did.
SPARSE_DROP_STEP1 = (
    "desc", "mths_since_last_delinq", "mths_since_last_record", "next_pymnt_d",
    "mths_since_last_major_derog", "annual_inc_joint", "dti_joint", "verification_status_joint",
    "open_acc_6m", "open_act_il", "open_il_12m", "open_il_24m", "mths_since_rcnt_il",
    "total_bal_il", "il_util has", "open_rv_12m", "open_rv_24m", "max_bal_bc", "all_util",
    "inq_fi", "total_cu_tl", "inq_last_12m", "mths_since_recent_bc_dlq", "mths_since_recent_inq",
    "mths_since_recent_revol_delinq", "revol_bal_joint", "sec_app_fico_range_low",
    "sec_app_fico_range_high", "sec_app_earliest_cr_line", "sec_app_inq_last_6mths",
    "sec_app_mort_acc", "sec_app_open_acc", "sec_app_revol_util", "sec_app_open_act_il",
    "sec_app_num_rev_accts", "sec_app_chargeoff_within_12_mths",
    "sec_app_collections_12_mths_ex_med", "sec_app_mths_since_last_major_derog",
    "hardship_type", "hardship_reason", "hardship_status", "deferral_term", "hardship_amount",
    "hardship_start_date", "hardship_end_date", "payment_plan_start_date", "hardship_length",
    "hardship_dpd", "hardship_loan_status", "orig_projected_additional_accrued_interest",
    "hardship_payoff_balance_amount", "hardship_last_payment_amount",
    "debt_settlement_flag_date", "settlement_status", "settlement_date", "settlement_amount",
    "settlement_percentage", "settlement_term",
)
# Step-1 redundant columns: no data, duplicates addr_state, a link.
REDUNDANT_DROP_STEP1 = ("member_id", "zip_code", "url")
# Step-2 columns replaced by parsed versions.
REPLACED_DROP_STEP2 = ("emp_length", "term", "loan_status", "tot_coll_amt", "tot_cur_bal", "issue_d")
# Step-2 free-text / high-variance text columns.
FREE_TEXT_DROP_STEP2 = (
    "emp_title", "disbursement_method", "debt_settlement_flag", "title", "earliest_cr_line",
    "last_pymnt_d", "last_credit_pull_d",
)
# Step-2 columns with many missing values, mostly known only once a loan is in trouble.
POST_OUTCOME_DROP_STEP2 = (
    "collections_12_mths_ex_med", "il_util", "total_rev_hi_lim", "acc_open_past_24mths",
    "earliest_cr_line", "bc_open_to_buy", "bc_util", "chargeoff_within_12_mths",
    "mo_sin_old_il_acct", "mo_sin_old_rev_tl_op", "mo_sin_rcnt_rev_tl_op", "mo_sin_rcnt_tl",
    "mort_acc", "mths_since_recent_bc", "num_accts_ever_120_pd", "num_actv_bc_tl",
    "num_actv_rev_tl", "num_bc_sats", "num_bc_tl", "num_il_tl", "num_op_rev_tl", "num_rev_accts",
    "num_rev_tl_bal_gt_0", "num_sats", "num_tl_120dpd_2m", "num_tl_30dpd", "num_tl_90g_dpd_24m",
    "num_tl_op_past_12m", "pct_tl_nvr_dlq", "percent_bc_gt_75", "pub_rec_bankruptcies",
    "tax_liens", "tot_hi_cred_lim", "total_bal_ex_mort", "total_bc_limit",
    "total_il_high_credit_limit",
)

# --- fixed values: categorical model inputs -------------------------------------------------
CATEGORICAL_COLUMNS = (
    "grade", "sub_grade", "home_ownership", "verification_status", "purpose", "addr_state",
    "issue_d_year", "initial_list_status", "application_type", "pymnt_plan", "hardship_flag",
)
# Grades run A..G; each has five sub-grades 1..5 (A1 < A2 < ... < G5).
GRADES = ("A", "B", "C", "D", "E", "F", "G")
SUB_GRADES = tuple(f"{g}{n}" for g in GRADES for n in range(1, 6))

# --- fixed values: exploration and modelling parameters -------------------------------------
ELBOW_KS = (2, 3, 4, 5, 6, 7, 9, 10, 11, 12, 16, 20)
LR_REG_PARAMS = (0.05, 0.1, 0.2, 0.4)
HASHED_FEATURES = 10000
SPLIT_TRAIN_TEST = (0.70, 0.30)
SPLIT_TRAIN_TEST_VALIDATION = (0.60, 0.20, 0.20)
MAX_MISSING_SHARE = 0.10

# Characters Python's str.split() treats as blanks (str.isspace), besides the line breaks
# \n and \r; Java's \s does not know most of them.
PY_BLANK_CHARS = (
    "\t\x0b\x0c\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NON_ASCII_CLASS = "[^\\x{00}-\\x{7F}]+"
