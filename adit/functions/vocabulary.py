"""Word lists and classes. All are fixed values: results depend on these exact words and their order.

A class list is ordered: the first entry whose word occurs in the text decides.
"""

from __future__ import annotations

# Issued equipment, word -> class.
EQUIPMENT_CLASSES = (
    ("шлифовальн", "инструмент"),
    ("диск", "расходный материал"),
    ("огнетушитель", "средство пожаротушения"),
    ("газоанализатор", "контрольно-измерительный прибор"),
    ("молоток", "инструмент"),
    ("лебедка", "оборудование"),
    ("пур-патрон", "расходный материал"),
    ("лом", "инструмент"),
    ("кувалда", "инструмент"),
    ("телефон", "средство связи"),
    ("каска", "СИЗ"),
    ("сапоги", "СИЗ"),
    ("костюм", "СИЗ"),
    ("респиратор", "СИЗ"),
)

# Workings, word -> class.
PREMISE_CLASSES = (
    ("лава", "лава"),
    ("очистной забой", "лава"),
    ("вентиляционный штрек", "вентиляционный штрек"),
    ("вш", "вентиляционный штрек"),
    ("конвейерный штрек", "конвейерный штрек"),
    ("кш", "конвейерный штрек"),
    ("сбойк", "сбойка"),
    ("уклон", "уклон"),
    ("ствол", "ствол"),
    ("камер", "камера"),
    ("станц", "станция"),
)

# Workings classified by their name instead of a stated type.
PREMISE_NAME_CLASSES = (
    ("лава", "лава"),
    ("вш", "вентиляционный штрек"),
    ("вентиляционный", "вентиляционный штрек"),
    ("кш", "конвейерный штрек"),
    ("конвейерный", "конвейерный штрек"),
    ("сбойк", "сбойка"),
    ("уклон", "уклон"),
    ("ствол", "ствол"),
    ("камер", "камера"),
)

# Damage, word -> class.
DAMAGE_CLASSES = (
    ("термические повреждения", "термические повреждения"),
    ("оплавление", "термические повреждения"),
    ("царапины", "механические повреждения"),
    ("износ", "механические повреждения"),
    ("ржавчина", "механические повреждения"),
    ("деформирована", "деформация"),
    ("трещины", "геомеханические нарушения"),
)

# Certificate kinds.
CERTIFICATE_CLASSES = (
    ("протокол испытаний", "протокол испытаний"),
    ("сертификат соответствия", "сертификат соответствия"),
    ("декларация", "декларация соответствия"),
)

# Sensor type words of the registry.
SENSOR_CLASSES = (
    ("ch4", "CH4"),
    ("co", "CO"),
    ("скорост", "SPEED"),
    ("speed", "SPEED"),
    ("давлени", "PRESSURE"),
    ("pressure", "PRESSURE"),
    ("сейсм", "SEISMIC"),
    ("seismic", "SEISMIC"),
)

# Unit of each sensor type.
SENSOR_UNITS = {
    "CH4": "%",
    "CO": "%",
    "SPEED": "m/s",
    "PRESSURE": "mmHg",
    "SEISMIC": "magnitude",
}

# Positions, first hit wins.
POSITIONS = (
    "ГРОЗ",
    "электрослесарь",
    "помощник ГРОЗ",
    "главный механик",
    "инженер-газовик",
    "начальник участка",
    "ВГСЧ",
)

# Chronology event types and their words, first type with a hit wins. Texts are folded to lower
# case before the words are looked up, so abbreviations in capitals do not count.
EVENT_TYPES = (
    ("сообщение о пожаре", ("горит", "пожар", "огонь", "загорание", "пламя")),
    ("взрыв", ("взрыв", "хлопок", "ударная волна", "бабах")),
    ("отключение энергии", ("энергию выбило", "свет погас", "отключили", "фидер")),
    ("эвакуация", ("выходите", "уходите", "эвакуация", "бегите", "дуйте")),
    ("задымление", ("дым", "задымление", "смог", "видимость")),
    ("превышение газа", ("превышение", "газ", "метан")),
    ("сейсмическое событие", ("толчок", "сейсмическое")),
    ("вызов помощи", ("вызываю", "план вводить", "помощь")),
    ("локализация очага", ("за секцией", "очаг", "секция", "видно")),
    ("тушение", ("тушим", "огнетушитель", "затушить", "вода")),
)

# Hypotheses and their words, first word with a hit is reported.
HYPOTHESES = (
    ("HYP-001", ("искра", "шлифмашинка", "искрение", "шлифовальная машинка", "ИП-2014Б", "инструмент")),
    ("HYP-002", ("газ", "метан", "загазирование", "превышение", "ППМК", "CH4", "СО")),
    ("HYP-003", ("воды нет", "орошение", "включи воду", "сухая", "подача воды", "не работает")),
    ("HYP-004", ("инструмент неисправен", "огнетушитель не сработал", "нарушение", "не соблюдали")),
    ("HYP-005", ("вентиляция", "воздух", "проветривание", "застой", "душно")),
)

# Words that make a witness sentence an event.
WITNESS_EVENT_WORDS = (
    "взрыв", "пожар", "горит", "дым", "эвакуация", "выходить",
    "отключение", "энергия", "пострадавший", "ожог",
)

# Words that make an inspection fact a violation.
VIOLATION_WORDS = (
    "износ", "ржавчина", "деформирована", "повреждени", "трещин",
    "царапины", "оплавлени", "выгорание", "срезанн", "нарушен",
)

# Words that make an inspection fact a statement of condition.
CONDITION_WORDS = (
    "чисто", "целые", "исправн", "работоспособн",
    "следов нет", "без повреждений", "не нарушена",
)

# Words that mark the title line of a regulation.
REGULATION_TITLE_WORDS = (
    "методическ", "руководств", "правила", "стандарт",
    "инструкц", "положени", "норматив",
)

# Answers meaning yes and no.
YES_WORDS = ("да", "+", "yes", "выполнено", "1")
NO_WORDS = ("нет", "-", "no", "не выполнено", "0")
