"""Fixed values that results depend on."""

# Weekday labels, Monday first.
WEEKDAY_NAMES = ["Lun", "Mar", "Mie", "Jue", "Vie", "Sab", "Dom"]

# Operation types counted as ticket sales.
SALE_OPERATIONS = ["AM", "BM", "CE", "CS", "NE", "NS"]

# Discount percent by passenger type.
PASSENGER_DISCOUNT = {
    "PF": 25, "AD": 0, "ES": 50, "IN": 50, "MA": 25, "NI": 50, "PD": 25, "PE": 0, "XA": 5,
    "ZA": 0, "ZB": 10, "VC": 25, "PH": 6, "FA": 0, "OD": 50, "XP": 25, "IF": 0, "SC": 0,
}

# Fare uplift percent by customer cluster.
CLUSTER_UPLIFT = {0: 5, 1: 3, 2: 7, 3: 13, 4: 0}

# Months, hours, weekdays (Monday is 0) and, by bus capacity, seats in high demand, in the
# order of the rule file.
GOOD_MONTHS = [4, 8, 1, 3, 7, 5]
GOOD_HOURS = [23, 22, 1, 12, 8, 14, 10]
GOOD_WEEKDAYS = [6, 0, 4]
GOOD_SEATS = {
    36: [3, 9, 2, 12, 8, 15, 11, 6, 13, 18, 5, 14, 7, 17, 1, 10, 21, 20, 16, 19],
    35: [3, 9, 2, 6, 5, 12, 8, 11, 15, 23, 14, 20, 22, 19, 13, 30, 10, 26, 4],
    33: [11, 22, 8, 9, 23, 5, 12, 14, 20, 19, 15, 25, 6, 26, 28, 31, 30, 2],
    30: [8, 9, 7, 30, 23, 11, 13, 12, 6, 15, 5, 17, 14, 20, 26, 16],
    27: [11, 8, 14, 15, 12, 9, 5, 3, 2, 18, 17, 6, 26, 20, 23],
    24: [1, 20, 14, 23, 2, 15, 12, 3, 11, 21, 19, 17, 24],
}

# Client types the fare model knows, and the two deck classes.
CLIENT_TYPES = ["AGENCIA", "CALLCENTER", "INTERNET", "NULL", "TAQUILLA"]
DECKS = ["DOS", "UNO"]

# Mean relative discount stored with the trained fare model.
TRAINED_MEAN_DISCOUNT = 0.0908963531255722

# Placeholder mail domain for passengers without one.
PLACEHOLDER_DOMAIN = "ejemplo.com"

# Fare bands: first lower bound, last upper bound, width.
FARE_BANDS = (250, 1800, 25)

# Days held out of training, counted back from the newest sale.
HOLDOUT_DAYS = 101

# Advance-sale classes in the order segments are found.
ADVANCE_CLASSES = {1: "Muy Alto", 2: "Alto", 3: "Media", 4: "Bajo"}
