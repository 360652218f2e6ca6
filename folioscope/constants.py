"""Literals whose exact spelling is part of the results."""

# Labels of the action log.
DOWNLOAD = "İndirme"
REGISTER = "Kaydolma"
CASH_IN = "Para Yatırma"
CASH_OUT = "Para Çekme"
FUND_BUY = "Fon Alma"
FUND_SELL = "Fon Satma"
AUTO_BUY = "Otonom Portföy Alma"
AUTO_SELL = "Otonom Portföy Satma"
ORDER_CANCEL = "Emir İptal Etme"
NEW_PORTFOLIO = "Yeni Portföy Oluşturma"
PROFILE_PICTURE = "Profil Resmi Ekli mi?"
MULTI_IBAN = "Birden Fazla Banka Hesabı Var mı?"

# Transaction types and the labels they stand for.
TX_LABELS = {"CIN": CASH_IN, "COU": CASH_OUT, "BUY": FUND_BUY, "SEL": FUND_SELL}
AUTO_LABELS = {"BUY": AUTO_BUY, "SEL": AUTO_SELL}
FUND_TX_TYPES = ("BUY", "SEL")

# Asset classes, list types, currency, survey and its answers.
AUTO_ASSET_CLASS = "Otonom Portföy"
PARTICIPATION_ASSET_CLASS = "Katılım"
POPULAR_LIST = "Popular"
CURRENCY = "TRY"
PROFILE_SURVEY = "Investor-Profile-Survey"
RISK_KEY = "Risk-Score"
BIT_KEY = "BIT"
NO_FUND = "NA"

# App views on which a fund code ends the details text.
FUND_VIEWS = ("fundsList", "fundMarket", "fundDetails")

# Text forms of times.
DISPLAY_PATTERN = "HH.mm-dd.MM.yy"
DISPLAY_PATTERN_SECONDS = "HH.mm.ss-dd.MM.yy"
NO_TIME = "N/A"
YEAR_MONTH_REGEX = r"^[0-9]{4}/[0-9]{2}$"

# Conversion events (seq, view, action, details).
CONVERSION_EVENTS = (
    (1, "account", "click", "deposit"),
    (2, "account", "click", "openAccount"),
    (3, "moneyTransfer", "click", "addBankAccount"),
)

# Events left out of conversion paths.
IGNORED_EVENTS = (
    "signIn - click - auto login",
    "foreground - open - app is on foreground",
    "foreground - open - app is on foreground ios",
    "background - open - app is on background ios",
    "background - open - app is on background",
    "settings - click - Çıkış Yap",
    "bottomTabBar - click - Hesabım",
    "bottomTabBar - click - Portföyüm",
    "account - click - settings",
    "account -  withdraw",
    "fundDetails - click - buy",
    "fundDetails - click - back",
    "settings - click - k Yap",
    "signn - click - auto login",
    "bottomTabBar - click - Hesabm",
    "bottomTabBar - click - Portfym",
)
IGNORED_WORDS = ("cancel", "close", "back", "chart", "zebra")

# Features counted or flagged from app events.  ``view``,
# ``action`` and ``details`` match a word anywhere, whatever its case;
# ``*_is`` matches the whole text exactly; ``night`` keeps 22:00 to 05:59.
EVENT_FEATURES = {
    "addBankAccount": {"kind": "flag", "details": "addBankAccount"},
    "settings": {"kind": "count", "view": "settings"},
    "bes": {"kind": "flag", "details": "besSuggestion"},
    "otonom": {"kind": "flag", "details": "investmentStrategies"},
    "pushNotification": {"kind": "count", "view": "pushNotification"},
    "compare": {"kind": "count", "view": "manageComparisonItems", "details": "apply"},
    "filterselection": {"kind": "count", "view": "filterSelection"},
    "sorting": {"kind": "count", "view": "fundsList", "details": "ChangeSortDirection"},
    "transactionsHistory": {"kind": "count", "view": "transactionsHistory"},
    "generalsummary": {"kind": "count", "details": "generalSummary"},
    "background": {"kind": "count", "view": "background", "action": "open"},
    "foreground": {"kind": "count", "view": "foreground", "action": "open"},
    "canceltransaction": {"kind": "count", "view": "account", "details": "canceltransaction"},
    "grihelpcenter": {"kind": "count", "view": "account", "details": "grihelpcenter"},
    "signup_night": {"kind": "count", "view": "bottomPopup", "details": "signUp", "night": True},
    "signin_night": {"kind": "count", "view": "bottomPopup", "details": "signin", "night": True},
    "order_night": {"kind": "count", "view": "orderDetail", "action": "close", "night": True},
    "addfavourite": {"kind": "count", "view": "fundDetails", "details": "addfavourite", "night": True},
    "video_izleyen": {"kind": "flag", "view_is": "feeds", "details_is": "close", "night": True},
    "dya_gece": {"kind": "flag", "view_is": "profiling", "details_is": "startAnalysis", "night": True},
}
STRATEGY_WORD = "investmentStrategies"
STRATEGY_DAYS = 7
PARTICIPATION_SHARE = 0.8
AGE_FROM, AGE_TO = 28, 48

# Hour buckets, first and last hour; the rest of the day is night.
HOUR_BUCKETS = {"early_morning": (5, 10), "work_time": (11, 16), "evening": (17, 22)}
NIGHT = "night"

# Sizes.
LOOKBACK_MONTHS = 6
SAMPLE_SIZE = 10_000
JDBC_BATCH = 1_000
