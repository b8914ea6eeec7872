"""Word lists and lookup tables that decide results, stated plainly."""

from __future__ import annotations

import re

# Fixed values.  Exactness of a fee by the first marker found, in this order.
EXACTNESS = {
    "from": "from", "starting at": "from", "starting from": "from", "up to": "range", "capped at": "range", "cap at": "range", "maximum": "range", "max": "range",
    "minimum": "from", "min": "from", "tiered": "tiered", "volume based": "tiered", "custom": "custom", "contact sales": "custom", "included": "included", "free": "free",
    "no additional fee": "included", "no additional charge": "included", "at no additional charge": "included", "no fee": "free", "at no cost": "free", "no cost": "free",
}

# Fixed values.  Currency symbols; those that stand for hundredths; currencies whose decimals aren't two; words of large sums.
SYMBOLS = {
    "$": "USD", "€": "EUR", "£": "GBP", "¥": "JPY", "₹": "INR", "A$": "AUD", "C$": "CAD", "HK$": "HKD", "S$": "SGD", "NZ$": "NZD", "CHF": "CHF", "R$": "BRL", "MX$": "MXN",
    "kr": "SEK", "zł": "PLN", "lei": "RON", "฿": "THB", "¢": "USD", "p": "GBP", "AED": "AED", "DKK": "DKK", "NOK": "NOK",
}
MINOR_SYMBOLS = ("¢", "p")
EXPONENTS = {"JPY": 0, "KRW": 0, "VND": 0, "BHD": 3, "IQD": 3, "JOD": 3, "KWD": 3, "OMR": 3, "TND": 3}
MAGNITUDES = ("billion", "million", "trillion")
CURRENCIES = (
    "USD", "EUR", "GBP", "JPY", "INR", "AUD", "CAD", "HKD", "SGD", "NZD", "CHF", "BRL", "MXN", "SEK", "PLN", "RON", "THB", "AED", "DKK", "NOK", "IDR", "MYR", "PHP", "VND", "KRW", "CNY", "ZAR", "ILS",
    "CZK", "HUF", "BGN", "HRK",
)

# Fixed values.  The five forms of an amount, in order of precedence: whether its unit stands before or after the number,
# and the pattern, in which {major}, {any}, {code} and {minor} stand for the units of that kind.
AMOUNT_FORMS = (
    ("before", r"(?P<unit>{major})\s*(?P<number>[0-9][0-9,.]*)"),
    ("after", r"(?P<number>[0-9][0-9\s,.]*)\s*(?P<unit>{any})(?!\w)"),
    ("before", r"(?P<unit>{code})\s*(?P<number>[0-9][0-9,.]*)"),
    ("after", r"(?P<number>[0-9][0-9\s,.]*)\s*(?P<unit>{code})(?!\w)"),
    ("tight", r"(?P<number>[0-9][0-9,.]*)(?P<unit>{minor})(?!\w)"),
)

# Fixed values.  Patterns of prices: a page's first fee, a card's title with a price, a price beside a method's name, a
# line that names a fee to come, and what makes a heading a fee.
FIRST_FEE = r"\d(?:\.\d)?%\s*(?:\+\s*)?(?:[^\d\s]?\s*[\d.,]+\s*[¢₹₽¥]|[^\d\s]?\s*[A-Z]?\$?\s*[\d.,]+)"
PRICED_TITLE = r"[0-9]\s*%|[0-9]\s*[€£$¥A-Z]|included|free"
PRICE_PATTERN = r"(?:\d\s*%|[A-Za-z]?[€£$¥₹₩]\s*\d|\d\s*[€£$¥₹₩])"
LABEL_LINE = r"(?i)^[^\d]{1,40}\b(?:fee|price)\b$"
FEE_HEADING = (r"[0-9]\s*%", r"[€£$¥A-Z]{1,3}\s*[0-9]", r"(?i)included|free")

# Fixed values.  The currency of each country.
CURRENCY_BY_COUNTRY = {
    "AU": "AUD", "AT": "EUR", "BE": "EUR", "BR": "BRL", "BG": "EUR", "CA": "CAD", "HR": "EUR", "CY": "EUR", "CZ": "CZK", "DK": "DKK", "EE": "EUR", "FI": "EUR", "FR": "EUR", "DE": "EUR", "GI": "GBP",
    "GR": "EUR", "HK": "HKD", "HU": "HUF", "IN": "INR", "ID": "IDR", "IE": "EUR", "IT": "EUR", "JP": "JPY", "LV": "EUR", "LI": "CHF", "LT": "EUR", "LU": "EUR", "MY": "MYR", "MT": "EUR", "MX": "MXN",
    "NL": "EUR", "NZ": "NZD", "NO": "NOK", "PL": "PLN", "PT": "EUR", "RO": "RON", "SG": "SGD", "SK": "EUR", "SI": "EUR", "ES": "EUR", "SE": "SEK", "CH": "CHF", "TH": "THB", "AE": "AED", "GB": "GBP",
    "US": "USD",
}

# Fixed values.  First currency by the first pattern that a phrase holds.
CURRENCY_PATTERNS = [
    (r"\b(?:US\$|\$)\s*\d", "USD"), (r"\b€\s*\d", "EUR"), (r"\b£\s*\d", "GBP"), (r"\bA\$\s*\d", "AUD"), (r"\bCA\$\s*\d", "CAD"), (r"\bJP¥\s*\d", "JPY"), (r"\b¥\s*\d", "JPY"),
    (r"\bAED\s*\d", "AED"), (r"\bINR\s*\d", "INR"), (r"\bBRL\s*\d", "BRL"), (r"\bIDR\s*[\d.]+", "IDR"),
]

# Fixed values.  Words of a page's controls that are no part of a fee.
CONTROLS = ("Show additional fees", "Hide additional fees", "Learn more", "Start now", "Contact sales", "Request early access")

# Fixed values.  Payment methods in order, and their families.
METHODS = (
    "sepa_direct_debit", "sepa_bank_transfer", "ach_direct_debit", "bacs_direct_debit", "pre_authorized_debit", "pad", "bancontact", "bizum", "blik", "eps", "ideal", "wero",
    "przelewy24", "swish", "twint", "pay_by_bank", "mb_way", "pix", "upi", "klarna", "billie", "scalapay", "multibanco", "alipay", "mobilepay", "paypal", "revolut_pay", "wechat_pay",
    "amazon_pay", "satispay", "konbini", "apple_pay", "google_pay", "click_to_pay", "cash_app_pay", "cash_app_afterpay", "afterpay", "clearpay", "affirm", "zip", "sunbit",
    "tap_to_pay", "link", "paypay", "card", "terminal", "bank_transfer",
)
FAMILIES = {
    "card": ("card", "domestic_card", "international_card", "premium_card", "standard_card"),
    "bank_debit": ("sepa_direct_debit", "sepa_bank_transfer", "ach_direct_debit", "bacs_direct_debit"),
    "bank_redirect": ("ideal", "wero", "bancontact", "eps", "blik", "przelewy24", "swish", "twint", "pay_by_bank", "mb_way", "pix", "upi", "bizum"),
    "wallet": ("alipay", "wechat_pay", "mobilepay", "paypal", "revolut_pay", "amazon_pay", "satispay"),
    "buy_now_pay_later": ("klarna", "billie", "scalapay"),
    "cash_voucher": ("multibanco",),
}

# Fixed values.  Wording of market shares.
MARKET_SHARE = (
    "share", "share of online payments", "share of online transactions", "share of e-commerce payments", "market share", "most popular payment method", "used in more than",
    "used by over", "adoption", "customers use", "active monthly users", "active global customers",
)
MARKET_SHARE_PATTERN = r"\b(more than|over)\s+[0-9]+%?\s*(share|of)\b"

# Fixed values.  Query parameters that don't change a page, and those that logs must not show.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term", "gclid", "fbclid", "ref", "referral")
SECRET = ("token", "session", "sid", "auth", "nonce", "csrf", "request_id", "correlation_id", "visitor_id")

# Fixed values.  Units of time or business that may stand beside another "per".
TIME_UNITS = ("month", "year", "day", "transaction", "charge", "dispute", "refund", "payout", "invoice")

# Fixed values.  Starts of lines that qualify the fee before them, and ends of lines that introduce the next one.
QUALIFIER_STARTS = ("of", "for", "if", "per", "starting at", "up to", "minimum", "maximum", "cap", "capped", "custom", "contact sales")
PREFIX_ENDS = ("starting at", "starting from", "up to", "minimum", "maximum", "from")

# Fixed values.  What the rule checks look for: wording of fees and plans, add-ons, variants of payments, states of disputes.
FEE_WORDING = r"\b(fee|charge|transaction|per\s+(charge|transaction|successful charge))\b"
PLAN_WORDING = {"custom": ("custom payments pricing", "custom pricing"), "standard": ("standard payments pricing", "standard pricing")}
ADDONS = ("authorization_boost", "radar", "smart_disputes", "three_d_secure")
ADDON_WORDING = [
    (("authorization boost", "authorisation boost"), "authorization_boost"), ("smart dispute", "smart_disputes"), (("3d secure", "3-d secure"), "three_d_secure"), ("radar", "radar"),
]
PAYMENT_VARIANTS = (
    "online_domestic_cards", "online_international_cards", "online_premium_cards", "in_person_domestic_cards", "in_person_international_cards", "in_person_premium_cards",
    "domestic_cards", "international_cards", "tap_to_pay",
)
DISPUTE_STATES = ("dispute", "lost", "won", "received", "countered")

# Fixed values.  Component types that make a rule without calculation a fee candidate.
FEE_TYPES = ("percentage", "fixed_amount", "percentage_surcharge", "fixed_surcharge", "minimum_fee", "maximum_fee")

# Fixed values.  Markers of a card's region; the earliest in the text counts.
CARD_REGIONS = [
    (r"\bnon-eea\b", "international"), (r"\bnon eea\b", "international"), (r"\beea\b", "eea"), (r"\beuropean economic area\b", "eea"), (r"\buk\b", "uk"), (r"\bunited kingdom\b", "uk"),
    (r"\bbritish\b", "uk"), (r"\binternational\b", "international"), (r"\bforeign(?! exchange)\b", "international"), (r"\bdomestic\b", "domestic"),
    (r"\bissued outside(?: of)?\b", "international"), (r"\bissued in\b", "domestic"),
]
EEA = (
    "AT", "BE", "BG", "HR", "CY", "CZ", "DK", "EE", "FI", "FR", "DE", "GR", "HU", "IS", "IE", "IT", "LV", "LI", "LT", "LU", "MT", "NL", "NO", "PL", "PT", "RO", "SK", "SI", "ES", "SE",
)

# Fixed values.  Card networks, as entries name them and as evidence of a fee names them.
NETWORKS = [(("american express", "amex"), "amex"), ("mastercard", "mastercard"), ("visa", "visa")]
NETWORK_NAMES = ("mastercard", "visa", "american express", "american_express", "amex", "discover", "jcb", "diners", "diners club", "unionpay")

# Fixed values.  Countries that a customer list names.
CUSTOMER_COUNTRIES = {
    "united states": "US", "usa": "US", "canada": "CA", "austria": "AT", "belgium": "BE", "germany": "DE", "netherlands": "NL", "switzerland": "CH", "czech republic": "CZ", "czechia": "CZ",
    "denmark": "DK", "finland": "FI", "france": "FR", "greece": "GR", "ireland": "IE", "italy": "IT", "norway": "NO", "poland": "PL", "portugal": "PT", "romania": "RO", "spain": "ES", "sweden": "SE",
    "united kingdom": "GB", "uk": "GB", "great britain": "GB", "australia": "AU", "new zealand": "NZ",
}

# Fixed values.  First-match tables of single dimensions: a substring, any of a tuple, all of a frozenset, or a pattern.
CARD_TIERS = [("premium", "premium"), ("standard", "standard")]
LINK_VARIANTS = [("instant bank payments", "instant_bank_payments"), ("for klarna", "klarna")]
AFFIRM_VARIANTS = [("affirm standard", "standard"), ("affirm enhanced", "enhanced")]
PRICING_TIERS = [("enhanced", "enhanced"), ("premium", "premium"), ("standard", "standard")]
CONTRACTS = [(re.compile(r"\b(?:1[-\s]year|one[-\s]year)\s+contract\b"), "1_year"), ("per month", "month_to_month"), ("monthly", "month_to_month")]
PRICING_PLANS = [(words, plan) for plan, words in PLAN_WORDING.items()]
SETTLEMENTS = [
    ("standard settlement", "standard"), ("instant settlement", "instant"), ("instant payout", "instant"), ("two-day settlement", "two_day"), ("two day settlement", "two_day"),
    ("same-day settlement", "same_day"), ("same day settlement", "same_day"),
]
TRANSACTIONS = [
    (("authorisation", "authorization"), "authorization"), (("per successful charge", "per charge"), "charge"), ("per payout", "payout"), ("bank account validation", "bank_account_validation"),
]
AMOUNT_ROLES = [(("cap", "capped", "maximum", "max"), "maximum_fee"), (("minimum", "min"), "minimum_fee")]
UNITS = [
    ("per month", "monthly"), ("monthly", "monthly"), ("per year", "yearly"), ("yearly", "yearly"), ("per invoice", "per_invoice"), ("per payout", "per_payout"), ("per refund", "per_refund"),
    ("per verification", "per_verification"), ("per active user", "per_active_user"), ("per user", "per_active_user"), ("per connected account", "per_connected_account"),
    (re.compile(r"(?:per\s+calculation\s+api\s+call|per\s+api\s+call|api\s+call)"), "per_api_call"), ("per screened transaction", "per_screened_transaction"),
    ("per screened payment", "per_screened_transaction"), (("per authorisation", "per authorization"), "per_attempt"), (re.compile(r"\bper\b.*\battempt\b|\battempt\b.*\bper\b"), "per_attempt"),
    ("per successful charge", "per_charge"), ("per charge", "per_charge"), (re.compile(r"\bwire\s+(?:payment|transfer)\b"), "per_charge"), ("per successful transaction", "per_transaction"),
    ("per transaction", "per_transaction"), (frozenset({"per successful", "transaction"}), "per_transaction"), (frozenset({"per successful", "charge"}), "per_charge"), ("per paid invoice", "per_invoice"),
]
PRODUCT_WORDS = [
    (("authorization boost", "authorisation boost"), "authorization_boost"), (("smart dispute", "smart disputes"), "smart_disputes"), (("dispute", "chargeback"), "disputes"), (("refund",), "refunds"),
    (("3d secure", "3-d secure", "customer authentication"), "three_d_secure"), (("instant payout", "instant pay"), "instant_payouts"), (("custom domain",), "custom_domain"),
    (("post-payment invoice", "post payment invoice"), "post_payment_invoice"),
    (("adaptive pricing", "adaptive acceptance", "uplift", "foreign exchange", "fx", "converted amount"), "adaptive_pricing"), (("invoic",), "invoicing"),
    (("subscription", "recurring billing"), "subscriptions"), (("stablecoin",), "stablecoin_payments"), (("managed payments",), "managed_payments"), (("radar",), "radar"),
    (("platform", "marketplace", "connect"), "platform"), (("identity verification", "identity"), "identity"), (("sigma",), "sigma"), (("billing",), "billing"), (("payout",), "payouts"), (("tax",), "tax"),
    (("terminal", "tap to pay", "in-person", "in person", "reader"), "terminal"),
]

# Fixed values.  Units of products without one of their own, and products that are methods with one.
PRODUCT_UNITS = {
    "payments": "per_transaction", "instant_payouts": "per_payout", "payouts": "per_payout", "adaptive_pricing": "per_transaction", "post_payment_invoice": "per_invoice", "invoicing": "per_invoice",
    "tax": "per_transaction", "managed_payments": "per_transaction", "three_d_secure": "per_transaction", "radar": "per_transaction", "smart_disputes": "per_dispute", "ach_direct_debit": "per_transaction",
    "identity": "per_verification", "billing": "per_transaction", "subscriptions": "per_transaction", "platform": "per_transaction", "connect": "per_transaction", "stablecoin_payments": "per_transaction",
    "refunds": "per_refund", "sigma": "per_charge",
}
DEBIT_PRODUCTS = ("ach_direct_debit", "sepa_direct_debit", "bacs_direct_debit")
METHOD_PRODUCTS = (
    "ideal", "wero", "bancontact", "eps", "blik", "przelewy24", "swish", "twint", "pay_by_bank", "mb_way", "pix", "upi", "bizum", "alipay", "mobilepay", "paypal", "revolut_pay", "wechat_pay", "amazon_pay",
    "satispay", "konbini", "link", "klarna", "billie", "scalapay", "multibanco",
)
ONLINE_PRODUCTS = (
    "disputes", "instant_payouts", "payouts", "three_d_secure", "payments", "adaptive_pricing", "post_payment_invoice", "invoicing", "tax", "managed_payments", "radar", "smart_disputes",
    "ach_direct_debit", "subscriptions", "billing", "identity", "custom_domain", "platform", "connect", "stablecoin_payments", "refunds", "sigma",
)

# Fixed values.  Units that complete a dangling "per"; lines that are part of a price; methods as page text names them, in order.
UNIT_NOUNS = ("resolution", "block", "lookup", "lookups", "deflection", "dispute", "refund", "transaction", "charge", "payout", "account", "user", "invoice", "verification")
PRICE_LINES = ("per", "month", "year", "transaction", "transactions", "learn more", "compare plans")
PAGE_METHODS = (
    "sepa direct debit", "sepa bank transfer", "ach direct debit", "bacs direct debit", "bancontact", "bizum", "blik", "eps", "ideal", "wero", "przelewy24", "swish", "twint", "pay by bank", "mb way", "pix",
    "upi", "klarna", "billie", "scalapay", "multibanco", "alipay", "mobilepay", "paypal", "revolut pay", "wechat pay", "amazon pay", "satispay", "konbini", "tap to pay", "link", "card", "terminal",
)
DISPUTE_WORDS = ("for lost disputes", "disputed payment", "failed payment", "per successful refund", "refund")

# Fixed values.  Wording of fees, of marketing, of promotions, of market statistics and of hardware.
FEE_TERMS = (
    "fee", "fees", "cost", "costs", "charge", "charged", "starting fee", "platform fee", "uplift", "pricing", "per transaction", "per successful charge", "per successful transaction", "per authorization",
    "per authorisation", "per payout", "per payout paid out", "per dispute", "per dispute payment", "per resolution", "per block", "per lookup", "per deflection", "per invoice", "per paid invoice",
    "per authorised", "per authorized", "per refund", "for refunds", "per verification", "per charge", "per screened transaction", "per connected account", "per active user", "per user", "per month",
    "monthly", "per year", "yearly", "maximum fee", "minimum fee", "max fee", "min fee", "cap", "capped", "percentage plus fixed amount", "processing fee", "transaction fee", "payment fee",
    "billing volume", "of billing volume", "currency conversion", "foreign exchange", "for international", "for domestic", "for cards", "for uk cards", "payment methods", "cross-border", "cross border",
)
MARKETING_TERMS = (
    "billion", "million", "trillion", "category leaders", "customers", "customer", "process more than", "process over", "api calls", "api requests", "revenue", "transaction volume", "transaction-volume",
    "ranking", "rankings", "100+", "100 +", "percent of", "percentage of", "year", "years", "annual", "annually", "share of", "market share", "most popular payment method", "popular payment method",
    "used in more than", "used by over", "active monthly users", "active global customers", "customers use", "adoption", "increase conversion", "increase acceptance", "return on investment", "roi",
    "uptime", "historical uptime",
)
PROMOTIONS = (
    "may qualify", "temporarily reduced", "temporarily lower", "contact sales", "contact us", "custom quote", "starting prices may apply", "waive", "waived", "try for free",
)
STATISTICS = (
    "share of online payments", "share of online transactions", "share of e-commerce payments", "market share", "most popular payment method", "used in more than", "used by over", "active monthly users",
    "active global customers", "customers use", "adoption", "increase conversion", "increase acceptance", "uptime", "historical uptime", "api requests", "api calls", "billion", "million", "trillion",
)
HARDWARE = ("reader", "readers", "device", "devices", "purchase", "purchased", "hardware", "terminal", "tap to pay", "price", "one-time")
PROCESSING = ("per successful", "per transaction", "per charge", "per in-person", "authorization fee", "processing fee", "transaction fee", "fee", "fees")
LEAST_HARDWARE_PRICE = 10

# Fixed values.  Wording that makes an entry a statistic; {provider} is the provider's name in lower case.  All words of a row must stand there.
NO_FEES = [
    ("99.999%", "uptime"), ("250 million",), ("api requests",), ("maximise your revenue",), ("maximize your revenue",), ("return on investment",), ("category leaders",), ("process more than",),
    ("process over",), ("from startups to fortune",), ("start building your integration",), ("explore how",), ("chose {provider}",), ("simplified cross-border payments with {provider}",),
    ("migrated", "months"), ("of subscription volume",), ("of customers",), ("tapped into",), ("increased", "with {provider}"), ("learn why",), ("read the docs",), ("customers use {provider}",),
]

# Fixed values.  Statuses: entries that need no further look; rules that are kept; evidence for a fee; statuses left to entries.
CLOSED = ("ignored_non_fee", "informational", "reference_only", "custom_pricing", "included", "free", "unsupported_fee_shape")
KEPT = ("calculable_rule", "included", "free", "non_calculable", "reference_only")
GOOD_EVIDENCE = ("explicit_fee_phrase", "pricing_table_value", "structured_fee_field")
BAD_EVIDENCE = ("marketing_prose", "promotional_language", "hardware_price", "alphanumeric_method_name", "insufficient", "contradictory_fee_evidence")
LEAST_CONFIDENCE = 0.7

# Fixed values.  Wording of pages with prices; countries with an address of their own; countries by name, in order.
PAGE_SIGNALS = (
    "standard pricing", "custom pricing", "pricing & fees", "preise", "preise und gebühren", "local payment methods", "domestic card", "international card", "per transaction", "per successful",
)
DIRECT_MARKETS = ("us", "gb", "au", "nz", "ie", "in", "ae")
COUNTRY_NAMES = {
    "australia": "AU", "austria": "AT", "belgium": "BE", "brazil": "BR", "bulgaria": "BG", "canada": "CA", "croatia": "HR", "cyprus": "CY", "czech republic": "CZ", "denmark": "DK", "estonia": "EE",
    "finland": "FI", "france": "FR", "germany": "DE", "gibraltar": "GI", "greece": "GR", "hong kong": "HK", "hungary": "HU", "india": "IN", "indonesia": "ID", "ireland": "IE", "italy": "IT",
    "japan": "JP", "latvia": "LV", "liechtenstein": "LI", "lithuania": "LT", "luxembourg": "LU", "malaysia": "MY", "malta": "MT", "mexico": "MX", "netherlands": "NL", "new zealand": "NZ", "norway": "NO",
    "poland": "PL", "portugal": "PT", "romania": "RO", "singapore": "SG", "slovakia": "SK", "slovenia": "SI", "spain": "ES", "sweden": "SE", "switzerland": "CH", "thailand": "TH",
    "united arab emirates": "AE", "united kingdom": "GB", "united states": "US",
}

# Fixed values.  What follows a unit's "per", up to three words.
PER_UNIT = r"\bper\b\s+((?:(?!\bper\b)[a-z0-9]+\s+){0,2}(?!\bper\b)[a-z0-9]+)"

# Fixed values.  Titles of pages that check who reads them; marks of their forms and frames; titles of pages to sign in.
CHALLENGE_TITLES = ("captcha", "security check", "verify you are human", "robot check", "challenge", "are you human", "verify your identity")
CHALLENGE_MARKS = r"(?is)<(?:form|iframe|input|div)[^>]*(?:captcha|challenge|security-check|human-verification)|cf-turnstile|g-recaptcha|h-captcha|rc-anchor-container|recaptcha"
LOGIN_TITLES = ("log in", "login", "sign in", "signin")
LOGIN_FORM = r"(?is)<form[^>]*(?:signin|login)|<input[^>]*type=[\"']?password"

# Fixed values.  Countries that are known before any page is read.
SEED_MARKETS = [
    ("us", "US", "United States", "north_america", "en-us", "en", "USD"), ("gb", "GB", "United Kingdom", "europe", "en-gb", "en", "GBP"), ("de", "DE", "Germany", "europe", "en-de", "en,de", "EUR"),
    ("au", "AU", "Australia", "asia_pacific", "en-au", "en", "AUD"), ("jp", "JP", "Japan", "asia_pacific", "en-jp", "en,ja", "JPY"), ("in", "IN", "India", "asia_pacific", "en-in", "en", "INR"),
    ("ae", "AE", "United Arab Emirates", "middle_east_africa", "en-ae", "en", "AED"), ("br", "BR", "Brazil", "south_america", "en-br", "en,pt", "BRL"),
    ("id", "ID", "Indonesia", "asia_pacific", "en-id", "en", "IDR"),
]

# Fixed values.  How pages of local methods mark a card and the parts of a price in it.
CARD_MARK, ROW_MARK, CAPTION_MARK, AMOUNT_MARK, LABEL_MARK, SUBPRICE_MARK = (
    "LocalPaymentMethodsPricingCard", "PricingGridPrice", "PricingGridPrice__caption", "PricingGridPrice__amount", "PricingGridPrice__label", "PricingGridSubprice",
)
