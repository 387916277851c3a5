import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shared_fixtures import write_text  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from goldenrec.session import build_session

    s = build_session("local[4]", cores=8, app="goldenrec-tests")
    s.conf.set("spark.sql.shuffle.partitions", "8")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="goldenrec-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="goldenrec-test-")


# Two customer systems, restated in our own rows: one person whose email
# differs only in case and whose phone lost its separators, one email shared
# by two first names (Bob / Robert), the rest unique.
CUSTOMERS_A = """customer_id,first_name,last_name,email,phone,address,city,country,registration_date,customer_type
K01,Ann,Lee,ann.lee@mail.test,+1-555-0201,1 First St,Boston,USA,2024-01-10,Gold
K02,Ben,Ray,ben.ray@mail.test,+1-555-0202,2 Second St,Austin,USA,2024-02-11,Basic
K03,Bob,Kent,bob.kent@mail.test,+1-555-0203,3 Third St,Denver,USA,2024-03-12,Gold
K04,Cara,Moss,cara.m@mail.test,+1-555-0204,4 Fourth St,Miami,USA,2024-04-13,Basic
K05,Dan,Cole,dan.c@mail.test,+1-555-0205,5 Fifth St,Tampa,USA,2024-05-14,Gold
"""
CUSTOMERS_B = """customer_id,first_name,last_name,email,phone,address,city,country,registration_date,customer_type
K01,Ann,Lee,ANN.LEE@MAIL.TEST,15550201,1 First Street,Boston,USA,2024-01-10,Gold
K06,Eve,Hart,eve.h@mail.test,+1-555-0206,6 Sixth St,Dallas,USA,2024-06-15,Basic
K07,Finn,Lowe,finn.l@mail.test,+1-555-0207,7 Seventh St,Reno,USA,2024-07-16,Gold
K03,Robert,Kent,bob.kent@mail.test,5550203,3 Third Road,Denver,USA,2024-03-20,Gold
K08,Gail,Nash,gail.n@mail.test,+1-555-0208,8 Eighth St,Omaha,USA,2024-08-17,Basic
"""
PRODUCTS_A = """product_id,product_name,category,brand,price,currency,stock_quantity,sku,weight_kg,is_active
Q1,Travel Laptop 14,Electronics,Acme,999.5,USD,10,SKU-TL-1,1.9,true
Q2,Trackball,Electronics,Acme,39.5,USD,50,SKU-TB-2,0.2,yes
Q3,Task Chair,Furniture,Sitwell,199.5,USD,5,SKU-TC-3,12.0,1
Q4,USB-C Dock,Electronics,Acme,89.5,USD,30,SKU-UD-4,0.4,no
Q5,Display 24",Electronics,Viewco,249.5,USD,12,SKU-D24-5,5.1,false
"""
PRODUCTS_B = """product_id,product_name,category,brand,price,currency,stock_quantity,sku,weight_kg,is_active
Q1,Travel Laptop 14 inch,Electronics,Acme,949.5,USD,9,SKU-TL-1,1.9,true
Q6,Desk Fan,Office,Breezy,25.5,USD,80,SKU-DF-6,1.1,true
Q3,Mesh Task Chair,Furniture,Sitwell,189.5,USD,4,SKU-TC-3,12.0,true
"""


@pytest.fixture()
def sample_sources(tmp_dir):
    write_text(f"{tmp_dir}/customers/sap/customers_a.csv", CUSTOMERS_A)
    write_text(f"{tmp_dir}/customers/salesforce/customers_b.csv", CUSTOMERS_B)
    write_text(f"{tmp_dir}/products/erp/products_a.csv", PRODUCTS_A)
    write_text(f"{tmp_dir}/products/warehouse/products_b.csv", PRODUCTS_B)
    return tmp_dir
