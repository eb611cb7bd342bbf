"""Value domains of the generated people."""

# The lists below must stay as they are, in this order, because a
# person is an index into them.
MALE_NAMES = [
    "Carlos", "Luis", "Jose", "Juan", "Miguel", "Jorge", "Diego", "Fernando", "Ricardo",
    "Eduardo", "Alejandro", "Roberto", "Francisco", "Manuel", "Sergio", "Axel", "Emiliano",
    "Mateo",
]
FEMALE_NAMES = [
    "Ana", "Maria", "Laura", "Sofia", "Lucia", "Fernanda", "Daniela", "Valeria", "Andrea",
    "Gabriela", "Patricia", "Rosa", "Carmen", "Alejandra", "Veronica", "Ximena", "Regina",
    "Camila",
]
SURNAMES = [
    "Lopez", "Garcia", "Martinez", "Hernandez", "Gonzalez", "Perez", "Rodriguez", "Sanchez",
    "Ramirez", "Cruz", "Flores", "Gomez", "Diaz", "Reyes", "Morales", "Jimenez", "Torres",
    "Vazquez", "Castillo", "Mendoza", "Ortiz", "Romero", "Alvarez", "Ruiz",
]
CITIES = [
    ("Aguascalientes", "Aguascalientes"),
    ("Jesus Maria", "Aguascalientes"),
    ("Guadalajara", "Jalisco"),
    ("Zapopan", "Jalisco"),
    ("Monterrey", "Nuevo Leon"),
    ("San Nicolas", "Nuevo Leon"),
    ("Ciudad de Mexico", "CDMX"),
    ("Puebla", "Puebla"),
    ("Queretaro", "Queretaro"),
    ("Leon", "Guanajuato"),
    ("Merida", "Yucatan"),
    ("Tijuana", "Baja California"),
    ("Cancun", "Quintana Roo"),
    ("Toluca", "Estado de Mexico"),
    ("Morelia", "Michoacan"),
    ("San Luis Potosi", "San Luis Potosi"),
]
OCCUPATIONS = [
    "Estudiante", "Ingeniero", "Doctor", "Maestro", "Abogado", "Contador", "Comerciante",
    "Empleado", "Disenador", "Programador", "Enfermero", "Arquitecto", "Mecanico", "Chef",
    "Electricista", "Administrador",
]
EDUCATION = ["Primaria", "Secundaria", "Preparatoria", "Licenciatura", "Maestria", "Doctorado"]
GENDERS = ["M", "F"]
MIN_AGE, MAX_AGE = 18, 80
MIN_INCOME_CENTS, MAX_INCOME_CENTS = 3_000_00, 80_000_00
FIRST_DAY, DAYS = "2024-01-01", 883  # up to and including 2026-06-01
