"""Fixed values.

Every value in this module must equal the one the pipeline's results are
defined by (category codes, reason codes, the prefecture pattern, the
half-width kana table and the match combinations). They are stated here
once, in their natural order, and used everywhere else by name.
"""

# ---- FIXED VALUES: conf category codes ----------------------------------
KEYWORD_PERSONAL_PHONE = "1"      # m_keyword: prefixes of personal phones
KEYWORD_COMPANY_EMAIL = "2"       # m_keyword: prefixes of company mailboxes
KEYWORD_PRESIDENT = "3"           # m_keyword: words of a president's title

REPLACE_TO_HYPHEN = "1"           # m_replace_string: hyphen look-alikes
REPLACE_COMPANY_NAME = "2"        # m_replace_string: company-form spellings
REPLACE_NO_JOB_POST = "3"         # m_replace_string: "no title" spellings

# ---- FIXED VALUES: validation reason codes -------------------------------
INVALID_MAIL = "INVALID_MAIL_ADDRESS_FORMAT"
INVALID_PHONE = "INVALID_PHONE_NUMBER"
INVALID_FAX = "INVALID_FAX_NUMBER"
INVALID_PREFECTURE = "INVALID_PREFECTURE"
NAME_ONLY = "PERSONAL_INFORMATION_NAME_ONLY"
INVALID_INVOICE_NO = "INVALID_INVOICE_COMPANY_NUMBER_FORMAT"
ERROR_REASONS = (INVALID_MAIL, INVALID_PHONE, INVALID_FAX, INVALID_PREFECTURE, NAME_ONLY, INVALID_INVOICE_NO)

# ---- FIXED VALUES: patterns ----------------------------------------------
# 2-3 kanji followed by one of the four prefecture suffixes (leftmost match).
PREFECTURE_PATTERN = "[一-龥]{2,3}(都|道|府|県)"
# "T" and 13 digits.
INVOICE_NO_PATTERN = "^T[0-9]{13}$"
PHONE_MIN_DIGITS = 10
PHONE_MAX_DIGITS = 11
CODE_WIDTH = 10                    # company_code / person_id are zero-padded to 10
ADDRESS_UNITS = ("丁目", "番地", "号室", "号")   # "<digits><unit>" becomes "<digits>-"
POSTAL_MARK = "〒"
NO_JOB_POST = "-"                 # empty job titles become this before the exact map
SPACES = " 　"                    # U+0020 and U+3000 are removed, nothing else

# ---- FIXED VALUES: half-width kana to full-width --------------------------
# Two-character (voiced / semi-voiced) keys are applied before single ones.
# There is deliberately no single-character entry for "ｯ".
HALF_TO_FULL_KANA = {
    "｡": "。", "､": "、", "･": "・", "ｰ": "ー",
    "ｧ": "ァ", "ｱ": "ア", "ｨ": "ィ", "ｲ": "イ", "ｩ": "ゥ", "ｳﾞ": "ヴ", "ｳ": "ウ",
    "ｪ": "ェ", "ｴ": "エ", "ｫ": "ォ", "ｵ": "オ",
    "ｶﾞ": "ガ", "ｶ": "カ",
    "ｷﾞ": "ギ", "ｷ": "キ",
    "ｸﾞ": "グ", "ｸ": "ク",
    "ｹﾞ": "ゲ", "ｹ": "ケ",
    "ｺﾞ": "ゴ", "ｺ": "コ",
    "ｻﾞ": "ザ", "ｻ": "サ",
    "ｼﾞ": "ジ", "ｼ": "シ",
    "ｽﾞ": "ズ", "ｽ": "ス",
    "ｾﾞ": "ゼ", "ｾ": "セ",
    "ｿﾞ": "ゾ", "ｿ": "ソ",
    "ﾀﾞ": "ダ", "ﾀ": "タ",
    "ﾁﾞ": "ヂ", "ﾁ": "チ",
    "ｯﾞ": "ッ", "ﾂ": "ツ",
    "ﾂﾞ": "ヅ",
    "ﾃﾞ": "デ", "ﾃ": "テ",
    "ﾄﾞ": "ド", "ﾄ": "ト",
    "ﾅ": "ナ", "ﾆ": "ニ", "ﾇ": "ヌ", "ﾈ": "ネ", "ﾉ": "ノ",
    "ﾊﾞ": "バ", "ﾊﾟ": "パ", "ﾊ": "ハ",
    "ﾋﾞ": "ビ", "ﾋﾟ": "ピ", "ﾋ": "ヒ",
    "ﾌﾞ": "ブ", "ﾌﾟ": "プ", "ﾌ": "フ",
    "ﾍﾞ": "ベ", "ﾍﾟ": "ペ", "ﾍ": "ヘ",
    "ﾎﾞ": "ボ", "ﾎﾟ": "ポ", "ﾎ": "ホ",
    "ﾏ": "マ", "ﾐ": "ミ", "ﾑ": "ム", "ﾒ": "メ", "ﾓ": "モ",
    "ｬ": "ャ", "ﾔ": "ヤ", "ｭ": "ュ", "ﾕ": "ユ", "ｮ": "ョ", "ﾖ": "ヨ",
    "ﾗ": "ラ", "ﾘ": "リ", "ﾙ": "ル", "ﾚ": "レ", "ﾛ": "ロ",
    "ﾜ": "ワ", "ｦ": "ヲ", "ﾝ": "ン",
}
# Applied after the table: small ka / ke become full-size.
SMALL_KA_KE = {"ヵ": "カ", "ヶ": "ケ"}

# ---- FIXED VALUES: character ranges (built from the rule, not listed) -----
FULLWIDTH_ASCII_FIRST, FULLWIDTH_ASCII_LAST, FULLWIDTH_OFFSET = 0xFF01, 0xFF5E, 0xFEE0
HIRAGANA_FIRST, HIRAGANA_LAST, KATAKANA_OFFSET = 0x3041, 0x3096, 0x60

# ---- FIXED VALUES: two-field match combinations, in order -----------------
COMPANY_COMBINATIONS = (
    ("company_name", "full_address"),
    ("company_name", "main_phone_number"),
    ("company_name", "main_email_address"),
    ("full_address", "main_phone_number"),
    ("full_address", "main_email_address"),
    ("main_phone_number", "main_email_address"),
)
PERSON_COMBINATIONS = (
    ("name", "phone_number"),
    ("name", "email_address"),
    ("phone_number", "email_address"),
)

# ---- FIXED VALUES: master layouts -----------------------------------------
M_COMPANY_COLUMNS = (
    "company_code", "company_name", "postal_code", "prefecture_code", "full_address",
    "employees_volume", "annual_revenue", "main_phone_number", "fax_number",
    "main_email_address", "url", "industry", "contact_permission", "president_person_id",
    "customer_flag", "supplier_flag", "payment_flag", "invoice_company_number",
    "insert_datetime", "update_datetime",
)
M_PERSON_COLUMNS = (
    "person_id", "name", "name_kana", "company_code", "department", "job_post",
    "phone_number", "email_address", "insert_datetime", "update_datetime",
)
COMPANY_FLAGS = ("contact_permission", "customer_flag", "supplier_flag", "payment_flag")
# Columns every person update sets, whatever the feed passes in.
PERSON_UPDATE_COLUMNS = (
    "name", "name_kana", "company_code", "department", "job_post",
    "phone_number", "email_address", "update_datetime",
)

# ---- FIXED VALUES: feed files --------------------------------------------------
# CSV columns per feed (work columns plus the date columns the files carry)
CSV_COLUMNS = {
    "crm": ("company_name", "department", "name", "name_kana", "job_post", "email", "phone_number",
            "url", "postal_code", "prefecture", "address", "industry", "employees_volume",
            "annual_revenue", "contact_permission", "register_datetime", "last_contact_datetime"),
    "name_card": ("family_name", "first_name", "family_name_kana", "first_name_kana", "company_name",
                  "department_name", "position_name", "postal_code", "address", "building",
                  "phone_number", "company_phone_number", "email", "company_email"),
    "purchase": ("company_name", "opponent_staff_name", "phone_number", "email_address", "address",
                 "invoice_company_number", "purchase_date"),
    "sales": ("customer_company_name", "customer_person_name", "phone_number1", "phone_number2",
              "email_address", "address", "sales_date", "scheduled_delivery_date",
              "actual_delivery_date", "deadline_deposit_date", "actual_deposit_date"),
    "invoice": ("invoice_issuer", "tel_number", "fax_number", "email", "address",
                "invoice_company_number", "invoice_date", "payment_deadline"),
}
DATE_COLUMNS = {
    "crm": ("register_datetime", "last_contact_datetime"),
    "purchase": ("purchase_date",),
    "sales": ("sales_date", "scheduled_delivery_date", "actual_delivery_date",
              "deadline_deposit_date", "actual_deposit_date"),
    "invoice": ("invoice_date", "payment_deadline"),
}
NUMBER_COLUMNS = {"crm": ("employees_volume", "annual_revenue")}
BOOLEAN_COLUMNS = {"crm": ("contact_permission",)}
CSV_FILE = {"crm": "crm.csv", "name_card": "namecard.csv", "purchase": "purchase_ledger.csv",
            "sales": "sales_ledger.csv", "invoice": "invoice.csv"}

# ---- FIXED VALUES: white space that trimming removes ----------------------------
STRIPPED = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# ---- FIXED VALUES: columns a manual merge fills (fax_number and update_datetime are not carried)
MERGE_COLUMNS = (
    "company_name", "postal_code", "prefecture_code", "full_address", "employees_volume",
    "annual_revenue", "main_phone_number", "main_email_address", "url", "industry",
    "contact_permission", "president_person_id", "customer_flag", "supplier_flag",
    "payment_flag", "invoice_company_number",
)
ZERO_IS_GAP = ("employees_volume", "annual_revenue")
