"""Word lists, patterns and formats that results depend on.

They are stated as given by the source systems and must not be changed.
"""

# ---- call-record feeds -------------------------------------------------------------------------

# Header spellings seen in the feeds -> canonical column name.
CDR_SYNONYMS = {
    "CDRDate1": "CDR_DATE",
    "START_DATE": "CDR_DATE",
    "START_DTTM": "CDR_DATE",
    "CDR_Date": "CDR_DATE",
    "CDRDate_Value": "CDR_DATE",
    "Carrier1": "CARRIER",
    "GlobalCarrier": "CARRIER",
    "GlobalCarrier_Value": "CARRIER",
    "CARRIER_SHORT_NAME": "CARRIER",
    "Branch": "BRANCH",
    "Region_Value": "BRANCH",
    "Traffic_Direction21": "DIRECTION",
    "Destination1": "DESTINATION",
    "Destination_Band": "DESTINATION",
    "Destination_Value": "DESTINATION",
    "OPERATOR_NAME": "DESTINATION",
    "TotalDurationInMinutes_Sum": "MINUTES",
    "TotalDurationInMinutes_Value": "MINUTES",
    "DURATION": "MINUTES",
    "Minutes": "MINUTES",
    "Total_Cost": "COST",
    "Cost": "COST",
    "Rate_List_Currency1": "CURRENCY",
    "Total_Calls_Connected": "TOTAL_CALLS_CONNECTED",
}

# Carrier and branch inside one text, and the carrier-type letter.
CARRIER_PATTERN = r"([A-Z]{1}\_[A-Z0-9]{3})\s([A-Z0-9]{2}\s[A-Z0-9]*)"
CARRIER_TYPE_PATTERN = r"([A-Z]{1})\_[A-Z0-9]{3}"
CARRIER_TYPES = ("T", "H")
EXCLUDED_CARRIERS = ("T_INT", "H_RTK")

# International dialling prefix removed from codes.
DIAL_OUT_PREFIX = "810"

# Date formats of the feeds, in order of preference (Spark patterns).
CDR_DATE_FORMATS = ("d.M.yyyy", "d.M.yy", "d/M/yyyy", "M/d/yyyy H:m:s")

# ---- file uploads ------------------------------------------------------------------------------

# Date formats accepted by the uploader, and its timestamp format (Spark patterns).
UPLOAD_DATE_FORMATS = ("yyyy-M-d", "d.M.yyyy", "d.M.yy", "d/M/yyyy")
UPLOAD_TIMESTAMP_FORMAT = "yyyy-M-d H:m:s"

# Upper bounds of the proposed text widths; longer text is LONG VARCHAR.
VARCHAR_STEPS = (11, 100, 500, 5000)

# Warehouse column-type codes -> Spark types.
TYPE_CODES = {
    "DA": "date",
    "TS": "timestamp_ntz",
    "CV": "string",
    "D": "decimal(18,6)",
    "F": "double",
    "I": "int",
    "I8": "bigint",
}

# Rule for column names.
NAME_PATTERN = "^[A-Za-z][A-Za-z0-9_]*$"

# ---- plan sheets -------------------------------------------------------------------------------

# Columns of the known plan sheets.
PLAN_SHEETS = {
    "data": ("version", "month", "year", "region", "account", "param_value"),
    "Data": ("version", "month", "year", "region", "account", "param_value"),
    "phd": ("version", "month", "year", "region", "base_type", "tariff", "account", "param_value"),
    "rev": ("version", "month", "year", "region", "base_type", "tariff", "account", "param_value"),
}
# Tariff and base codes of the plan sheets, version names, the account that keeps monthly rows.
PLAN_TARIFFS = {"1100": "Bundle", "2000": "PAYG", "#": "NO SUBS"}
PLAN_BASE_TYPES = {"#": "NOT A"}
BUDGET_VERSION = "BU"
ACTUAL_VERSION = "AC"
PASSTHROUGH_ACCOUNT = "GMC  (w/o group )"
FORECAST_PATTERN = "F%"

# ---- sales mix ---------------------------------------------------------------------------------

# Names and marks of the sales-mix sheets.
SALES_MIX_PARAM = "SM Plan"
REGION_MARKER = "Регион"
PLAN_MARKER = "план"
PLAN_SUFFIX_PATTERN = r"(.+)\s*план"
DIV_ZERO_SENTINEL = "0x7"

# Region spellings of the sheets -> dictionary spelling.
SALES_MIX_REGIONS = {
    "Краснодар": "Краснодар и Адыгея",
    "Салехард": "ЯНАО",
    "Абакан": "Хакасия",
    "Чебоксары": "Чувашия",
    "Ростов-на-Дону": "Ростов на Дону",
    "Санкт-Петербург": "С.Петербург",
    "Ханты-Мансийск": "ХМАО",
    "Нижний Новгород": "Н.Новгород",
    "Великий Новгород": "В.Новгород",
    "Саранск": "Мордовия",
    "Йошкар-Ола": "Марий Эл",
    "Улан-Удэ": "Бурятия",
}
# Header spellings of the old layout -> names of columns and plans. Spellings that hold a company's name are
# left to the caller, who hands over the whole dictionary.
SALES_MIX_HEADERS = {
    "Регион": "region",
    "Channels": "channel",
    "МР": "macroregion",
    "Кластер": "cluster",
    "Мой безлимит": "Безлимит",
    "Мой разговор/Lite": "Мой разговор",
    "Мой онлайн/Online": "Мой онлайн",
    "Мой онлайн +": "Мой онлайн+",
}

# Branch names that are not retail branches, and the unassigned cluster.
EXCLUDED_BRANCH_MARKS = ("CDMA", "MVNO", "LTE450")
DEFERRED_CLUSTER = "Deferred"

# ---- brand tracking ----------------------------------------------------------------------------

# Columns of the tracking table, its area spellings, and the marks in sheets and headers.
TRACKING_COLUMNS = (
    "kpi", "operator", "area_cat", "area", "cat_1", "cat_2", "cat_3",
    "period_start", "period_end", "param_value", "source_table",
)
TRACKING_AREAS = {
    "Total Russia all": "Total Russia",
    "Center": "Центр",
    "Chernozem": "Черноземье",
    "Baikal & Far East": "Байкал и Дальний Восток",
    "North-West": "Северо-Запад",
    "Siberia": "Сибирь",
    "South": "Юг",
    "Volga": "Волга",
    "Ural": "Урал",
    "Moscow": "Москва и область",
}
KEPT_TOTAL_AREA = "Total Russia all"
OWN_MARK = "Есть"
OWN_LABEL, OTHER_LABEL = "Свой", "Чужой"
CHANGE_MARK, BASE_MARK, QUARTER_MARK = "Изменение", "Base", "Q"

# KPI names and area categories of the tracking workbooks.
EXPRESS_KPIS = (
    "AA", "AL", "BA", "Consideration", "CP", "ICP", "IQP", "PLP", "QP", "VFM", "NPS",
    "Для таких людей как я", "Честный", "Удобный, простой",
)
GENERAL_KPIS = ("AA", "AL", "BA", "Consideration", "CP", "ICP", "IQP", "PLP", "QP", "VFM")
SOCIAL_KPIS = GENERAL_KPIS + ("NPS",)
EXPRESS_AREA_CATS = ("Macro New", "Region", "Total")
GENERAL_AREA_CATS = ("Cluster New", "Macroregion new", "Region new", "Region old", "Total Russia")
SOCIAL_AREA_CATS = ("Cluster New", "Macroregion New", "Region new", "Region old", "Total Russia")
GENERAL_BREAKDOWN = ("Subs / nonsubs",)
SOCIAL_BREAKDOWNS = ("Area", "ARPU declared", "Arpu declared")

# Tracking headers -> canonical names, per workbook layout.
EXPRESS_HEADERS = {
    "Показатель": "kpi",
    "География\n (Total / macro / region)": "area_cat",
    "География": "area_cat",
    "Выбор": "area",
    "Оператор": "operator",
}
GENERAL_HEADERS = {
    "Показатель": "kpi",
    "Оператор": "operator",
    "Категория": "area_cat",
    "Категория_Выбор": "area",
    "Вариант1": "cat_3",
}
SOCIAL_HEADERS = {
    "Показатель": "kpi",
    "Оператор": "operator",
    "Категория": "area_cat",
    "Категория_Выбор": "area",
    "Разбивка1": "cat_1",
    "Вариант1": "cat_2",
}
SOCIAL_SUBS_HEADERS = {**SOCIAL_HEADERS, "Вариант2": "cat_3"}

# Per layout the endings of file names (Cyrillic and Latin) and the sheets that hold the data.
TRACKING_FILES = {
    "express": (("Экспресс-мониторинг показателей трекинга",), EXPRESS_KPIS),
    "general": (("Основные", "Osnovnye"), ("Динамика KPIs",)),
    "social_subs": (("Соц дем абоненты", "Soc dem abonenty"), ("data",)),
    "social": (("Соцдем", "Socdem"), ("data",)),
}

# ---- shared target layout ----------------------------------------------------------------------

# The parameters table, in insert order.
PARAMETERS_SCHEMA = (
    "report_date date, param_1 string, param_2 string, param_3 string, param_4 string, branch_id int, "
    "base_type string, tp_id_1 int, tp_id_2 int, tariff_1 string, tariff_2 string, param_value double"
)
LIVE_BASE_KPI = "Core Live Subs"

# ---- market data -------------------------------------------------------------------------------

# Column names looked up in the exchange's history block.
HISTORY_FIELDS = ("SECID", "LEGALCLOSEPRICE", "NUMTRADES")
