from clicklens.plans.apps import main

main()
