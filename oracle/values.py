"""The oracle's own copy of the domain's values, so that a wrong value in the library
shows as a mismatch instead of being shared. Plain text, kept by hand.
"""

# --- fixed values: domain ----------------------------------------------------
SUBWAY_LINES = ('YU', 'BD', 'SHP', 'SRT')
DELAY_CATEGORIES = ('Mechanical', 'Passenger', 'Security', 'Infrastructure', 'Operations', 'Weather', 'Signal', 'General')
CITY_BBOX = (43.58, 43.86, -79.64, -79.1)
MIN_TRIP_SECONDS = 60
TRIP_SECONDS_RANGE = (60, 86400)
FRESHNESS_WARN_DAYS = 45
FRESHNESS_ERROR_DAYS = 90
MIN_SUBSTRING_MATCH = 4
LIMITED_SAMPLE_N = 30
PEAK_MIN_RECORDS = 100
STATION_SUFFIXES = (' STATION TO', ' STATION (LEAVING', ' STATION (APPROA', ' STATION (TO KING', ' STATION (TOWARDS',
 ' STATION (LEA', ' STATIO', ' STATION', ' STN')
FACILITY_SUFFIXES = (' YARD', ' CARHOUSE', ' CAR HOUSE', ' GARAGE', ' SHOPS', ' SHOP', ' COMPLEX', ' DIVISION', ' DIVSION',
 ' WYE', ' PORTAL', ' HOSTLER', ' BUILD UP', ' BUILD-UP', ' BUILDUP', ' CENTRE TRACK', ' CENTER TRACK',
 ' CENTER', ' CENTRE', ' SUBSTATION', ' ESB', ' EE')
LINE_SUFFIXES = (' BD', ' YUS', ' YU', ' SRT', ' SHP', ' SHEP')
PREFIX_CATEGORY = {'MU': 'Mechanical',
 'PU': 'Passenger',
 'SU': 'Security',
 'EU': 'Infrastructure',
 'TU': 'Operations',
 'MR': 'Mechanical',
 'PR': 'Passenger',
 'SR': 'Security',
 'ER': 'Infrastructure',
 'TR': 'Operations',
 'MF': 'Mechanical',
 'PF': 'Passenger',
 'SF': 'Security',
 'EF': 'Infrastructure',
 'TF': 'Operations',
 'MT': 'Mechanical',
 'PT': 'Passenger',
 'ST': 'Security',
 'ET': 'Infrastructure',
 'TT': 'Operations',
 'NT': 'General'}
PREFIX_LABEL = {'MU': 'Mechanical',
 'PU': 'Passenger',
 'SU': 'Security',
 'EU': 'Equipment',
 'TU': 'Train Operations',
 'MR': 'SRT Mechanical',
 'PR': 'SRT Passenger',
 'SR': 'SRT Security',
 'ER': 'SRT Equipment',
 'TR': 'SRT Operations',
 'MF': 'Fleet Mechanical',
 'PF': 'Fleet Passenger',
 'SF': 'Fleet Security',
 'EF': 'Fleet Equipment',
 'TF': 'Fleet Operations',
 'MT': 'Streetcar Mechanical',
 'PT': 'Streetcar Passenger',
 'ST': 'Streetcar Security',
 'ET': 'Streetcar Equipment',
 'TT': 'Streetcar Operations',
 'NT': 'Streetcar General'}
TEXT_CATEGORY = {'Cleaning': 'Operations',
 'Cleaning - Disinfection': 'Operations',
 'Cleaning - Unsanitary': 'Operations',
 'Collision - TTC': 'Operations',
 'Collision - TTC Involved': 'Operations',
 'Diversion': 'Operations',
 'Emergency Services': 'Security',
 'General Delay': 'General',
 'Held By': 'Operations',
 'Investigation': 'Security',
 'Late': 'Operations',
 'Late Entering Service': 'Operations',
 'Late Leaving Garage - Operator': 'Operations',
 'Management': 'Operations',
 'Mechanical': 'Mechanical',
 'Operations': 'Operations',
 'Operations - Operator': 'Operations',
 'Overhead': 'Infrastructure',
 'Rail/Switches': 'Infrastructure',
 'Road Blocked - NON-TTC Collision': 'Operations',
 'Securitty': 'Security',
 'Security': 'Security',
 'Utilized Off Route': 'Operations',
 'Vision': 'Operations'}
CODE_CATEGORY_OVERRIDES = {'PREL': 'Infrastructure', 'PTW': 'Weather', 'PRW': 'Weather'}
TYPE_PATTERNS = {'DATE': '^\\d{4}-\\d{2}-\\d{2}([T ]00:00:00)?$',
 'TIME': '^\\d{1,2}:\\d{2}(:\\d{2})?$',
 'INTEGER': '^-?\\d+(\\.0)?$',
 'DECIMAL': '^-?\\d+\\.?\\d*$',
 'TIMESTAMP': '^\\d{1,2}/\\d{1,2}/\\d{4}\\s+\\d{1,2}:\\d{2}$|^\\d{4}-\\d{2}-\\d{2}[T '
              ']\\d{2}:\\d{2}(:\\d{2})?$'}
HOLIDAYS = (("New Year's Day", 1, 'fixed', 1), ('Family Day', 2, 'nth_monday', 3), ('Good Friday', None, 'easter', -2),
 ('Victoria Day', 5, 'monday_on_or_before', 24), ('Canada Day', 7, 'fixed', 1),
 ('Civic Holiday', 8, 'nth_monday', 1), ('Labour Day', 9, 'nth_monday', 1),
 ('Thanksgiving', 10, 'nth_monday', 2), ('Christmas Day', 12, 'fixed', 25))
KEY_DELIMITER = '-'
KEY_NULL_SENTINEL = '_null_'
MAP_RADIUS_MIN = 50
MAP_RADIUS_MAX = 500

# --- fixed values: rendering of the test bed ------------------------------------
BED_BOUNDS = ('N', 'S', 'E', 'W')
BED_CODE_PREFIXES = ('MU', 'PU', 'SU', 'EU', 'TU', 'MR', 'PR', 'SR', 'ER', 'TR', 'MF', 'PF', 'SF', 'EF', 'TF', 'MT', 'PT', 'ST',
 'ET', 'TT', 'NT')
BED_CODE_SUFFIXES = ('SC', 'DDX', 'O', 'WEA', 'ATC', 'XQ')
BED_DESCRIPTION_OVERRIDES = (('PUO', 'Passenger Other'),)
BED_REDELIVERY_EVERY = 50
BED_REGION_LINES = ('YU', 'BD', 'SHP', 'SRT', 'YU/BD')
BED_STATION_ALIASES = (('LEVEL 3', 'ST_004'), ('TRACK LEVEL 5', 'ST_007'), ('LEVEL 5', 'ST_009'), ('LEVEL 8', 'ST_016'), ('LEVEL 8', 'ST_015'))
BED_STATION_OVERRIDES = (('NATION_3 YARD', 'ST_010', 'BD'),)
BED_STATION_PREFIXES = ('', '', '', '', 'APPROACHING ', '', '', 'NEAR ')
BED_STATION_SUFFIXES = ('', ' STATION', ' STN', ' TO KIPLING', '', ' YARD', ' BD', ' PLATFORM')
BED_SUFFIX_DESCRIPTIONS = (('ATC', 'Automatic Train Control Fault'), ('D', 'Door Malfunction'), ('DD', 'Door Delay'), ('O', 'Other'),
 ('SC', 'Speed Control Restriction'), ('WEA', 'Weather'))
BED_TEXT_CODES = ('Mechanical', 'Diversion', 'Late', 'Security', 'Vision', 'General Delay')
