"""Fixed values.

Everything below must equal the values of the warehouse being rebuilt for the
results to match (labels shown in dashboards, codes stored in the sources).
They are data, kept together here in their natural order.
"""

# --- fixed values: identifiers --------------------------------------------
ZERO_GUID = "00000000-0000-0000-0000-000000000000"
NULL_TEXTS = ("", "null")

# --- fixed values: calendar labels (1-based month / ISO weekday order) -----
MONTH_NAMES = (
    "Январь", "Февраль", "Март", "Апрель", "Май", "Июнь",
    "Июль", "Август", "Сентябрь", "Октябрь", "Ноябрь", "Декабрь",
)
DAY_NAMES = (
    "Понедельник", "Вторник", "Среда", "Четверг", "Пятница", "Суббота", "Воскресенье",
)
# agronomic phase by calendar month 1..12
AGRO_PHASES = (
    "хранение", "хранение", "подготовка", "подготовка", "посадка", "вегетация",
    "вегетация", "вегетация", "уборка", "уборка", "хранение", "хранение",
)
SEASON_START_MONTH = 7          # the farm season runs July N .. June N+1, labelled N
CALENDAR_START = "2020-01-01"   # default calendar span (4,018 days)
CALENDAR_END = "2030-12-31"

# --- fixed values: field-number parsing -----------------------------------
FIELD_PREFIX_PATTERN = r"(?iu)^Поле\s+"

# --- fixed values: labels and defaults ------------------------------------
EQUIPMENT_TYPE_UNKNOWN = "Не определён"
OPERATION_GROUP_NONE = "Без группы"
SORT_UNKNOWN = "Сорт не указан"
IRRIGATION_UNKNOWN = "Не указан"
COLOR_WHITE_PATTERN = "%белый%"
COLOR_WHITE = "Белый"
COLOR_RED_PATTERN = "%красный%"
COLOR_RED = "Красный"
NOMENCLATURE_UNNAMED = "Номенклатура из взвешивания без наименования"
NOMENCLATURE_TECH_KIND = "Техническая запись"
NOMENCLATURE_TECH_CATEGORY = "Номенклатура не загружена из 1С"
UNRESOLVED_ITEM_PREFIX = "[Не загружено из 1С] "
UNRESOLVED_UNIT = "Не определена"
TOTAL_LABEL = "Итого"

# --- fixed values: weighing kinds and field resolution ---------------------
WEIGHING_FROM_FIELD = "СПоля"
WEIGHING_TRANSFER = "Перемещение"
RESOLVED_BY_STRUCTURE = "company_structure_description"
UNRESOLVED = "unresolved"

# --- fixed values: movement operations -> (movement type, sign) ------------
MOVEMENT_KINDS = (
    ("ПередачаМатериаловВПроизводство", "material_issue_to_production", -1),
    ("ПередачаПродукцииИзПроизводства", "production_receipt", 1),
    ("ПередачаМатериаловВКладовую", "material_return_to_warehouse", 1),
    ("ПередачаПродукцииИзКладовой", "product_issue_from_warehouse", -1),
)
OPERATION_MATERIAL_ISSUE = MOVEMENT_KINDS[0][0]
OPERATION_HARVEST_RECEIPT = MOVEMENT_KINDS[1][0]

# --- operating limits (tuning, not reference values) -----------------------
# a catalog is broadcast to the fact side only after its size is checked to be
# at most this; above it the lookup is a shuffle join (AQE splits hot keys)
LOOKUP_BROADCAST_MAX_BYTES = 64 << 20

# --- fixed values: operating defaults of the loaders -----------------------
LOOKBACK_HOURS = 48
OPEN_END_DATE = "9999-12-31"
TOP_N = 15
