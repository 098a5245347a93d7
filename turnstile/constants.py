"""Fixed values of the business: labels, word lists and lookup tables.

Everything here is data that results depend on literally.  The jobs take these
lists as arguments with these defaults, so another chain can pass its own.
"""

# ---- Fixed values: labels -------------------------------------------------
TOTAL = "Итого"
ALL_CITIES = "По всем городам"
NO_ANSWER = "Без ответа"
TICKET_CATEGORY = "Билеты"
ADD_ON_TOKEN = "орм"
LEVEL_DETAIL = "Детальные данные"
LEVEL_CITY = "Итого по городу"
LEVEL_CHANNEL = "Итого по каналу"
LEVEL_ALL = "Общий итог"

# ---- Fixed values: order statuses ----------------------------------------
REVENUE_STATUSES = ("paid", "transfer_payment")
FEE_STATUSES = ("paid", "return_payment_reject", "paid_ur", "paid_offline")

# ---- Fixed values: fee rates ---------------------------------------------
SERVICE_FEE_RATE = "0.025"
ACQUIRING_FEE_RATE = "0.022"

# ---- Fixed values: seconds between a sale and its survey answer ----------
ANSWER_WINDOW_SECONDS = 8

# ---- Fixed values: city names, Russian to English ------------------------
CITY_RU_TO_EN = {
    "Москва": "Moscow",
    "Яхрома": "Moscow",
    "Санкт-Петербург": "Saint_Petersburg",
    "Ростов-на-Дону": "Rostov_On_Don",
    "Екатеринбург": "Ekaterinburg",
    "Казань": "Kazan",
    "Волгоград": "Volgograd",
    "Эльбрус": "Elbrus_region",
    "Чегем": "Chegem",
    "Омск": "Omsk",
    "Воробьевы Горы": "Vorobyovy_Gory",
    "Тюмень": "Tumen",
    "Уфа": "Ufa",
    "Саратов": "Saratov",
    "Набережные Челны": "Nab_chelny",
}

# ---- Fixed values: till name to city -------------------------------------
TILL_TO_CITY = {
    "ККТ с передачей в ОФД (Эльбрус)": "Elbrus_region",
    "ККМ (Ростов)": "Rostov_On_Don",
    "ККТ с передачей в ОФД (Омск)": "Omsk",
    "ККТ с передачей в ОФД (Москва)": "Vorobyovy_Gory",
    "ККТ с передачей в ОФД (Уфа)": "Ufa",
    "ККТ с передачей в ОФД (Волгоград)": "Volgograd",
    "ККТ с передачей в ОФД (ЕКБ)": "Ekaterinburg",
    "ККТ с передачей в ОФД (Тюмень)": "Tumen",
    "ККТ с передачей в ОФД (СПБ)": "Saint_Petersburg",
    "ККТ с передачей в ОФД (Яхрома)": "Moscow",
    "ККТ с передачей в ОФД (Казань)": "Kazan",
}

# ---- Fixed values: budget sheet channel to survey channel ----------------
BUDGET_CHANNELS = {
    "Яндекс.Карты": "Яндекс.Карты",
    "Тик-Ток Посевы": "Тикток (соц.сеть)",
    "Инстаграм Посевы": "Инстаграм (соц.сеть)",
    "Гугл Карты": "Гугл.Карты",
    "2gis": "Карты 2gis",
    "Телеграм Посевы": "Телеграм (мессенджер)",
    "ВК ADS": "Вконтакте (соц.сеть)",
    "Телеграм ADS": "Телеграм (мессенджер)",
}
# Share of the sheet amount that counts, per budget sheet channel.
BUDGET_SHARES = {"Инстаграм Посевы": (2, 3)}

# ---- Fixed values: channels of the weekly mart (the total comes last) ----
MART_CHANNELS = (
    "Канатная дорога",
    "охта парк",
    "Авито",
    "Youtube (соц.сеть)",
    "Инстаграм (соц.сеть)",
    "Rutube",
    "Одноклассники",
    "Групповая Экскурсия",
    "вакансия на хх",
    "Афиша Timepad",
    "Забыли спросить у клиента",
    "Карты 2gis",
    "Клиент не помнит",
    "Наружная реклама",
    "Посоветовали друзья",
    "Google (поисковая система)",
    "Листовки",
    "Пинтерест (соц.сеть)",
    "Проходили мимо",
    "Сайт парка (в котором находится наш объект)",
    "Тикток (соц.сеть)",
    "Яндекс (поисковая система)",
    "Яндекс.Карты",
    "Вконтакте (соц.сеть)",
    "Пришли повторно",
    "Промокод Блогер",
    "Клиент отказался отвечать",
    "Смс",
    "Гугл.Карты",
    "Телеграм",
    "Итого",
)

# ---- Fixed values: columns of the daily answer pivot ---------------------
# One answer text has a column name that is cut short; all others are equal.
PIVOT_CHANNELS = {
    "Карты 2gis": "Карты 2gis",
    "Яндекс.Карты": "Яндекс.Карты",
    "Гугл.Карты": "Гугл.Карты",
    "Google (поисковая система)": "Google (поисковая система)",
    "Яндекс (поисковая система)": "Яндекс (поисковая система)",
    "Инстаграм (соц.сеть)": "Инстаграм (соц.сеть)",
    "Тикток (соц.сеть)": "Тикток (соц.сеть)",
    "Вконтакте (соц.сеть)": "Вконтакте (соц.сеть)",
    "Телеграм (мессенджер)": "Телеграм (мессенджер)",
    "Пинтерест (соц.сеть)": "Пинтерест (соц.сеть)",
    "Youtube (соц.сеть)": "Youtube (соц.сеть)",
    "Туристический сайт": "Туристический сайт",
    "Сайт парка (в котором находится наш объект)": "Сайт парка (в котором находится на",
    "Афиша Timepad": "Афиша Timepad",
    "Телевидение": "Телевидение",
    "Наружная реклама": "Наружная реклама",
    "Листовки": "Листовки",
    "Проходили мимо": "Проходили мимо",
    "Смс": "Смс",
    "Посоветовали друзья": "Посоветовали друзья",
    "Пришли повторно": "Пришли повторно",
    "Клиент не помнит": "Клиент не помнит",
    "Клиент отказался отвечать": "Клиент отказался отвечать",
    "Забыли спросить у клиента": "Забыли спросить у клиента",
}

# ---- Fixed values: sortable label of rank 1, 2, 3, ... -------------------
RANK_LABELS = (
    "a_0", "a_1", "b_2", "c_3", "d_4", "e_5", "f_6", "g_7",
    "h_8", "i_9", "j_10", "k_11", "l_12", "m_13", "n_14", "o_15",
    "p_16", "q_17", "r_18", "s_19", "t_20", "u_21", "v_22", "w_23",
    "x_24", "y_25", "z_26", "za_27", "zb_28", "zc_29", "zd_30", "ze_31",
)

# ---- Fixed values: headings of the landed files --------------------------
RECEIPT_HEADINGS = {
    "Дата": "sale_date",
    "Касса ККМ": "kkm",
    "Идентификатор чека в очереди": "receipt_id",
    "Чек ККМ": "receipt_name",
    "Запасы.Номенклатура.Категория": "item_category",
    "Запасы.Номенклатура.Код": "itenm_id",
    "Запасы.Номенклатура": "item",
    "Запасы.Количество": "qty",
    "Запасы.Сумма": "amount",
}
ANSWER_HEADINGS = {
    "Период": "date",
    "Значение": "value",
    "Количество": "qty",
    "Склад": "city",
}
SHEET_CHANNEL = "Канал"
WEEK_SHEET_SERVICE_COLUMNS = ("Канал", "Неделя", "Дата с", "Дата по")
MONTH_SHEET_SERVICE_COLUMNS = ("Канал", "Год", "month", "Месяц")

# ---- Fixed values: words of the weekly report ----------------------------
REPORT_TITLE = "Отчет по продажам за "
NO_CHANGE = "—"
UP_MARK = "🟢"
DOWN_MARK = "🔴"
